"""Demand analytics as ordinary Spark plans over tables and streams."""
