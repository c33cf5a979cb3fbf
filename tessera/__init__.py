"""tessera: Spark-native publication analytics and expert retrieval.

Every public operator takes and returns Spark DataFrames, takes column
names as arguments and composes with ``DataFrame.transform``.
"""

import sys as _sys

__version__ = "0.1.0"

# Ship the package's functions to Python workers by value: executors then
# need no copy of this package on their path (Arrow / pandas kernels are
# pickled together with the helpers they call).
try:  # pragma: no cover - depends on the installed pyspark
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
