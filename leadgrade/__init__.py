"""leadgrade: sales-lead ranking as Spark DataFrame operators."""

__version__ = "0.1.0"
