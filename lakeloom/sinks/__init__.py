"""Writers: partitions, refreshes, upserts, batches, records."""
