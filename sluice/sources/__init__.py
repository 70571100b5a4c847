"""Readers, batch-wise datasets and writers."""
