"""tessera: building-footprint analytics on Spark.

Footprint measures, equal-area hexagonal cell assignment, mergeable cell
metrics, spatial thinning into a quadkey-sorted zoom pyramid, profiling and
validation -- all expressed as DataFrame plans.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so executors run the UDFs
    and the data source without the package installed on them."""
    import sys

    try:
        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()
