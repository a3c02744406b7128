"""Spark jobs for parking citations and the daily weather they were issued in."""
