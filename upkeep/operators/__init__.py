"""Skew-safe relational building blocks shared by every report."""
