"""The library's operators applied to the given tables, each next to plain SQL for the same result."""
