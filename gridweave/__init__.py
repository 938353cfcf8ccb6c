"""gridweave: PySpark operators for table-shaped documents and the data around them."""

__version__ = "0.1.0"
