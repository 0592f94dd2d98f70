"""Driver-side planning: fragment balance, compaction bins, pruning."""
