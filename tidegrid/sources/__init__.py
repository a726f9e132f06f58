"""Readers: provider listings, state tables, grids, cells, file facts."""
