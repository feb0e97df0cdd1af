"""Reading delivered files, published snapshots and clustered tables."""
