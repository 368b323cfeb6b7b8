"""A PySpark engine that builds, keeps and analyses a corpus of web pages."""

__version__ = "0.1.0"
