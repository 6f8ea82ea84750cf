"""ledgerloom: trustworthy batch ingestion and data-quality operators on plain Spark."""

__version__ = "0.1.0"
