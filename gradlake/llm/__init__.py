"""Operators for large training-data pipelines: quality, decontamination, archives, pages, lines, secrets, URLs, copies, search, tokens."""
