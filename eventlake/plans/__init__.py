"""Staging models, the star schema and the hourly pipeline."""
