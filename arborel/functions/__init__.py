"""Column functions: geometry, projections and discrete grids."""
