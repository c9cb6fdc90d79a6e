from plumbline.catalogue import suites, tables, transfer  # noqa: F401  (registers the queries)
from plumbline.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
