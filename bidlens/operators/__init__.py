"""DataFrame-to-DataFrame steps of the bid analysis."""
