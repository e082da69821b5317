"""DataFrame transformations, one module per stage of a linkage run."""
