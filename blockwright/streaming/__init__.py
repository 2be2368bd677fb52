"""streaming of the block lakehouse."""
