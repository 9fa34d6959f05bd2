"""tuneforge: instruction-tuning data preparation as Spark DataFrame jobs."""

__version__ = "0.1.0"


def _pickle_by_value() -> None:
    """Ship this package's functions to Python workers by value, so executors need no install
    of the package (UDF bodies, user callables defined here)."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: fall back to import by reference
        pass


_pickle_by_value()
