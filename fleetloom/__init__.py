"""Spark-native analytics for fleets of vehicles that report their position."""
