"""DataFrame -> DataFrame operators: cleaning, KPIs, views, quality checks."""
