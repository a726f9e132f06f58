"""Column expressions: names, masks, units, time windows, geometry, layouts."""
