"""Event telemetry on Spark: collect, land, load, model and measure."""

__version__ = "0.1.0"
