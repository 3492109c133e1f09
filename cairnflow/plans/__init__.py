"""Named queries: each module has QUERIES (name to callable) and SQL (name to text)."""
