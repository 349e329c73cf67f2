"""Operators of a training-data pipeline, written for Spark."""
