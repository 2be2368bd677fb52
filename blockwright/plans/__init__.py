"""plans of the block lakehouse."""
