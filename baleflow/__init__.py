"""Order and sales analytics on Spark: batch preparation, messages, running totals."""
