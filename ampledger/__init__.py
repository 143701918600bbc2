"""Sensor-fleet analytics as functions from DataFrame to DataFrame."""
