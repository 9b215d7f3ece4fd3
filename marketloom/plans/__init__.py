"""Composite models: silver, gold, quality, features, forecasts and read queries."""
