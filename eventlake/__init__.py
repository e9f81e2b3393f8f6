"""eventlake: Spark jobs and DataFrame operators for hourly, semi-structured event data."""
