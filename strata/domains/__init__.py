"""strata package."""
