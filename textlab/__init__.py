"""textlab: Spark-native analytics for labelled text.

Every public function maps DataFrame(s) to a DataFrame (or a Column to a
Column).  Work stays inside Catalyst / whole-stage codegen; Python runs only
in two Arrow-batched places (accent stripping of non-ASCII rows and the
per-partition loss/gradient of the linear solver).
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so Python workers (local or on
    a cluster) run the Arrow UDFs without the package being installed there."""
    import sys

    try:
        from pyspark import cloudpickle
    except ImportError:  # pragma: no cover
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()
