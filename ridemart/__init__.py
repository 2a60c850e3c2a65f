"""ridemart: ride-trip analytics on PySpark (load, layout, models, checks, regression)."""

__version__ = "0.1.0"
