"""metropulse: urban-mobility analytics as Spark DataFrame jobs."""
