"""Campaign-finance filings on Spark: raw scans, staging, marts,
quality checks, probe-log analytics and document search."""

__version__ = "0.1.0"
