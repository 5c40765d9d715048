"""Tabular analysis as Spark jobs: quality, profiles, charts, features, models."""
