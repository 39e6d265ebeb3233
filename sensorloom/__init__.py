"""Sensor-stream analytics on PySpark."""
