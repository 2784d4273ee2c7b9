"""Service-request analytics on Spark: page ingest, star schema, metrics, data checks."""
