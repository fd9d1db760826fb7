"""Image-footprint analytics and corpus operators as PySpark DataFrame jobs."""
