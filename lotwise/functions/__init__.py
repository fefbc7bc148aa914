"""Column functions: values, geometry, projections."""
