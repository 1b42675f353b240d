"""Contributor-geography analytics as Spark DataFrame operators."""
