"""Whole jobs: feature building, training and forecasting."""
