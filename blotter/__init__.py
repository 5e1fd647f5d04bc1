"""blotter: Spark-native incident analytics (batch marts, stream alerts, serving queries)."""

__version__ = "0.1.0"
