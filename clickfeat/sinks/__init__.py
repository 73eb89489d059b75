"""Writers for the published tables."""
