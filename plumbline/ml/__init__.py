"""Models on MLlib, their parameters and their search."""
