"""Recipes and the end-to-end run."""
