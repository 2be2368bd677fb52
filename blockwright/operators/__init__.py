"""operators of the block lakehouse."""
