"""Tests of the text operators."""
