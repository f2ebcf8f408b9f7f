"""Layered (bronze, silver, gold) delivery analytics as plain Spark DataFrame functions."""
