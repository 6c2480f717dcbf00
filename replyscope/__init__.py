"""replyscope: retrieval, reply generation and reply scoring as Spark jobs."""
from __future__ import annotations

import sys

# Functions of this package that run on executors (pandas UDFs, mapInPandas
# and applyInPandas bodies) are pickled by value, so executors need no copy
# of the package on their Python path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: ship with --py-files
    pass

__version__ = "0.1.0"
