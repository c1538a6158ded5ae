"""Layered analytics on Spark: raw JSON landings, typed views, keyed marts and checks."""
