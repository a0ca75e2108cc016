"""sifter: corpus preparation and passage retrieval as Spark jobs.

Packages: ``functions`` (column expressions), ``sources`` (readers and the
views over the driver tables), ``operators`` (layout, search, context,
model hooks), ``sinks`` (writers), ``plans`` (end-to-end jobs and the
registered queries), ``streaming`` (incremental ingest).
"""

import sys as _sys

__version__ = "0.1.0"

# Functions of this package that run in Python workers (mapInPandas bodies,
# the stand-in models) travel with the task by value, so executors need not
# have the package installed or on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: ship the package with --py-files instead
    pass
