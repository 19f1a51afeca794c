"""Jobs: dimensions, warehouse, marts, reports, checks and the whole pipeline."""
