"""Business operators: cleaning, integration, features, reports."""
