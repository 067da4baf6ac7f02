"""Offline feed analytics as Spark DataFrame plans."""
