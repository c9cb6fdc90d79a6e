from plumbline.plans.fuse import evaluate
from plumbline.plans.registry import expectation, registered
from plumbline.plans.rules import Rule, rules_from_config, rules_from_frame, rules_to_frame

__all__ = ["Rule", "evaluate", "expectation", "registered", "rules_from_config", "rules_from_frame", "rules_to_frame"]
