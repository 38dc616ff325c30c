"""Column-level building blocks: keys, geohash cells, field rules."""
