"""Cohort-scale outlier enrichment as Spark jobs."""

__version__ = "0.1.0"
