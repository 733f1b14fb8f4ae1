"""Named queries, marts and their SQL oracle."""
