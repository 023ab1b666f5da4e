"""Spark-native building blocks for a historised retail star schema."""
