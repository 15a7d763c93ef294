"""teledex: web pages and wiki dumps to a searchable catalogue of series, on Spark."""
