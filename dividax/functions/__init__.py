"""dividax.functions."""
