"""Retail analytics on Spark: validation, star schema, marts, segments, forecasts, attribution."""
