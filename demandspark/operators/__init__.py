"""DataFrame-to-DataFrame operators on demand and forecast tables."""
