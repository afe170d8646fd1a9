"""dividax.operators."""
