"""Tick analytics on Spark: parse, validate, de-duplicate and window market
ticks from a topic, upsert the means into a keyed table, track offsets."""

import sys as _sys

try:  # ship this package's UDF code with the UDF (workers need not import it)
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: rely on --py-files
    pass
