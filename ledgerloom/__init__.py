"""Two-sided marketplace finance as Spark DataFrame jobs.

Every operator takes DataFrames and parameters and returns a DataFrame; the
work stays on the executors and inside Spark's own expressions.
"""
