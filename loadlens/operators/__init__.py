"""DataFrame -> DataFrame operators over run tables."""
