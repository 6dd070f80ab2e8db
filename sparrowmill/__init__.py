"""Text co-occurrence, inverted index, PageRank and k-means as Spark DataFrame jobs."""
