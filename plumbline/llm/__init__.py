"""Operators for preparing training data."""

import sys

from pyspark import cloudpickle

# Python workers get the code of this subpackage with each task, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from plumbline.llm.queries import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]
