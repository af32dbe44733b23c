"""Ensemble-forecast analytics and corpus preparation as Spark DataFrame jobs."""
