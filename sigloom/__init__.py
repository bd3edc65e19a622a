"""Topic signatures, text features and extractive summaries as PySpark DataFrame jobs."""
