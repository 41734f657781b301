"""Batch and streaming table jobs on PySpark: file checks, retail KPIs, health lake."""
