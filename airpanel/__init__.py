"""Analytics for hourly sensor panels, expressed as Spark DataFrame jobs."""
