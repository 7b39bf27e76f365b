"""riskmart: auditable insurance warehousing as plain Spark jobs."""

__version__ = "0.1.0"
