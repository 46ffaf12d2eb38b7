"""Readers and the prediction writer."""
