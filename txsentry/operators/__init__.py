"""Operators: cleaning, statistics, metrics, sampling, A/B tests, features, models."""
