"""End-to-end compositions: stand-in relations, runs, grids, the query registry."""
