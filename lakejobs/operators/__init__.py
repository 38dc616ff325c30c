"""DataFrame-to-DataFrame operators: merge, history, quality, upkeep."""
