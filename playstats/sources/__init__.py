"""Inputs: CSV/JSON readers, the model over the driver tables, raw inputs derived from them."""
