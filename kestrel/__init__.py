"""kestrel: tabular, text and time-series analytics operators as lazy Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from kestrel.session import get_session, checkpoint_dir  # noqa: E402

__all__ = ["get_session", "checkpoint_dir"]
__version__ = "0.2.0"
