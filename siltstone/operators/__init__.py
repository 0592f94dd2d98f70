"""Writing, evolving, deleting, compacting and indexing tables."""
