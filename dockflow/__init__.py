"""Spark-native demand and shortage analytics for shared-vehicle docks."""
