"""Queries composed from the operators: reports, feature views, recommendations, SQL views."""
