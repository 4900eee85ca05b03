"""tidewater: Spark-native event ingest, serving queries, feature preparation and
model training.  Every operator takes and returns a DataFrame; only sinks, the
registry and the quality gate's raise act eagerly."""

__version__ = "0.1.0"
