"""Traffic-stop analytics as reusable PySpark DataFrame operators and batch jobs."""
