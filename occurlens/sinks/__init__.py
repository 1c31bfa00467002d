"""Writers: partitioned Parquet checkpoints, KPI tables, keyed
replace-by-year, optional JDBC target, and the load report."""
