"""Ratings, requests and profiles taken from the given tables, the query list and its SQL twins."""
