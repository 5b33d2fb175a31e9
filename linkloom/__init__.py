"""linkloom: link and page analytics on Spark DataFrames."""

import sys as _sys

__version__ = "0.1.0"

# UDFs and mapInPandas functions of this package are pickled by value, so
# executors run them without an installed copy of the package (no --py-files
# needed, and the driver's working directory does not matter).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship the package instead
    pass
