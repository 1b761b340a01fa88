"""quern: relational, text, matrix, report and stream jobs as PySpark DataFrame operators."""

__version__ = "0.1.0"
