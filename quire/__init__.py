"""quire: a PySpark-native analytics engine for language-course corpora."""

__version__ = "0.1.0"
