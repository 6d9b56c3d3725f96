"""Contest analytics on Spark: ledgers of two-sided matches, line-ups and player seasons."""
