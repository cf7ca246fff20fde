"""Evidence-grounded corpus analytics expressed as PySpark DataFrame and SQL plans."""

__version__ = "0.1.0"
