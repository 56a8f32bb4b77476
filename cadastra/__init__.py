"""Property billing on Spark: events in, billing tables out."""
