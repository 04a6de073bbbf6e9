"""The queries registered in __spark_entry__."""
