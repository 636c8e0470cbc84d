"""Rental-marketplace analytics as lazy Spark DataFrame plans."""
