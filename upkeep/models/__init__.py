"""Distributed anomaly, failure and part-demand models."""
