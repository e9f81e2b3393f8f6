"""Reading hourly event files, the raw table and the load-audit table."""
