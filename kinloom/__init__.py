"""Entity resolution over tables of records, on Spark's DataFrame API."""
