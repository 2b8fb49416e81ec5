"""Column functions: calendar features, metrics and rounding."""
