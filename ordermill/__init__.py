"""Order analytics on Spark: landing checks, enrichment, upsert, quality and cost reports."""

__version__ = "0.1.0"
