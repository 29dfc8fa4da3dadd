"""Annual corporate filings on Spark: collect, flatten, derive, lay out."""
