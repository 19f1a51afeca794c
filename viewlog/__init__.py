"""Viewing-log analytics on Spark: landing files to staging, star schema, marts, reports and checks."""
