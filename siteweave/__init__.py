"""siteweave: a Spark-native engine for facility registries and their records."""

__version__ = "0.1.0"
