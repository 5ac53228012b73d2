"""Graph sources: graphs derived from the driver's Parquet tables, and the
reference's literal fixtures (tests only)."""
