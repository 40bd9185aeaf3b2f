"""goldpan: Bronze, Silver and Gold layers for batches of retail sales, on Spark DataFrames."""
