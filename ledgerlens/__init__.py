"""ledgerlens: sales feature engineering and regression-model evaluation on Spark DataFrames.

Every operator is a function ``DataFrame -> DataFrame`` (or a fit/transform pair whose fitted
state is a small profile) built from built-in Spark SQL expressions, aggregates, joins and windows.
"""

__version__ = "0.1.0"

# Ship this package's functions (pandas UDFs and their helpers) to Python workers by value,
# so executors need no installed copy of the package.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
