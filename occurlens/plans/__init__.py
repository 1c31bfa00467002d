"""Plans: the end-to-end pipeline (full and per-year refresh) and the
catalogue of named queries used by the entry point and the benchmark."""
