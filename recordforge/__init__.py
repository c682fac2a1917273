"""recordforge: a PySpark-native engine for document-derived records."""

__version__ = "0.1.0"
