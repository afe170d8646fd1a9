"""dividax.plans."""
