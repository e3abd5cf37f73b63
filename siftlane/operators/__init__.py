"""DataFrame operators: chunking, embedding, block top-k scans, two-stage
search and sentence isolation."""
