"""Keeping derived tables fresh as new files arrive."""

from cardamom.streaming.daily_sales import follow_fact_table, start_after

__all__ = ["follow_fact_table", "start_after"]
