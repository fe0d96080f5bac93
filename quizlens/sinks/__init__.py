"""Writing: staged intermediates, partitioned tables, upserts, ledgers, exports."""
