"""Operators put together into whole predictions and the spark-submit job."""
