"""Electricity-meter analytics on Spark: ingest, reports, alerts, power model."""
