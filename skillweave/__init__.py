"""skillweave: labour-market analytics as PySpark DataFrame jobs."""
