"""Compensation and job-posting analytics as composable Spark DataFrame functions."""
