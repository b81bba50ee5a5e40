"""billtrace: DataFrame operators and ready tables for legislative records, on Spark."""

from .session import tune  # noqa: F401

__version__ = "0.1.0"
