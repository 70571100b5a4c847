"""Ordered lists of operators (recipes) and their checkpoints."""
