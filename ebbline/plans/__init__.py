"""Ready-made jobs, and the catalogue of checked queries."""
