"""Raw file readers and layer tables."""
