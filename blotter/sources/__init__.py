"""Sources: CSV ingest, period unions, generated-table mapping."""
