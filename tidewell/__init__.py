"""Tidewell: an event-lakehouse analytics engine written on Spark's DataFrame and SQL layer."""
