"""chunkloom: document collections to index-ready rows, as Spark DataFrame operators."""

__version__ = "0.1.0"
