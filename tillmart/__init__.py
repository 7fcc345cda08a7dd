"""Sales analytics on Spark: intake, loading, datamarts, export and dashboard queries."""
