"""Ride-hailing trip analytics as Spark DataFrame plans."""
