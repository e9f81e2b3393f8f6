"""The hourly jobs as Structured Streaming micro-batches."""
