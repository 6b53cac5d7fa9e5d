"""Customer analytics for retail orders, written as Spark DataFrame jobs."""

from tallyloom.config import FEED_CONFIG, RetailConfig

__all__ = ["FEED_CONFIG", "RetailConfig"]
