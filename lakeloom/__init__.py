"""lakeloom: a PySpark-native engine for curating machine-learning datasets."""

__version__ = "0.1.0"
