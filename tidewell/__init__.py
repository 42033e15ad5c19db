"""Tidewell: bulk ingestion of landed API pages and tables, as Spark jobs."""

__version__ = "0.1.0"
