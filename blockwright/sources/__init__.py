"""sources of the block lakehouse."""
