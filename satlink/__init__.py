"""Spark-native data-vault engine: staging, hubs, links, satellites, PIT, marts and checks."""
