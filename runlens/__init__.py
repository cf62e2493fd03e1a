"""runlens: SQL cells, run telemetry, log shipping and keyed steps as Spark DataFrames.

Every operator takes DataFrames (or a session) and returns DataFrames; the caller
owns the session.  Python code that has to run on executors is pickled by value, so
nothing needs to be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
