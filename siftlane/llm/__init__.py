"""Training-data operators: search, filtering, near-duplicates, archives and
token files.  Nothing outside this subpackage imports it."""
