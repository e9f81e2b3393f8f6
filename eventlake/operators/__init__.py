"""DataFrame operators: merges, activity reports, load monitoring, data quality."""
