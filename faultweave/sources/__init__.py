"""Table sources and the shared scratch folder."""
