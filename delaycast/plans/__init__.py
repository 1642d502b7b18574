"""Pipelines made of the operators: features, the delay model, its registry, the daily batch."""
