"""ledgerloom: cataloguing, linking, searching and auditing metadata collections, as PySpark DataFrame plans."""

__version__ = "0.1.0"
