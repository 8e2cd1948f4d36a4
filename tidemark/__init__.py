"""tidemark: market time-series analytics on Spark.

Lazy ``DataFrame -> DataFrame`` operators for quote grids, rolling
features, labels, patterns, portfolio and classification reports, with
scale-safe plan shapes (``tidemark.plans``) and Structured Streaming state
machines (``tidemark.streaming``).
"""

__version__ = "0.1.0"


def _pickle_by_value() -> None:
    """Ship this package's code inside the task closures (cloudpickle by value).

    Executors then need no installed copy of ``tidemark``: pandas functions and
    the helpers they call travel with each task, whatever the worker's path.
    """
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # noqa: BLE001  (older cloudpickle: fall back to --py-files / addPyFile)
        pass


_pickle_by_value()
