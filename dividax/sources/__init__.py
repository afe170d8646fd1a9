"""dividax.sources."""
