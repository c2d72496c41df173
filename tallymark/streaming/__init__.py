"""Applying a fitted model to files as they arrive."""
