"""Reports, quality metrics and the batch job that produces them."""
