"""Timing products, comparing strategies, and reading what Spark recorded about them."""
