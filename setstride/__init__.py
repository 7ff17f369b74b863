"""Time-ordered sequences of item-sets on Spark: state, scoring and walk-forward evaluation."""

import sys

from pyspark import cloudpickle

from setstride.config import DRAWS, Domain
from setstride.operators.layout import StepTable, build_steps

# Functions that run in tasks travel with their code, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["DRAWS", "Domain", "StepTable", "build_steps"]
