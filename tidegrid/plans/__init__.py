"""Jobs composed from operators: harvest planning, regridding, aggregation."""
