"""Table writes: append, upsert, insert-if-absent, landing files and compaction."""
