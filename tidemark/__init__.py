"""Incremental, idempotent loading and reporting on Spark."""
