"""Appraisal-roll analytics as Spark DataFrame jobs."""
