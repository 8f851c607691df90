"""Interest-label mining from text, written as PySpark DataFrame jobs."""
