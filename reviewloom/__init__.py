"""Customer-review analytics as composable Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from reviewloom.session import build_session, prepare

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "prepare"]
