"""Daily station observations on Spark: land, clean, check, merge, publish, query."""
