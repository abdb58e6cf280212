"""Integration of many field-trial datasets with weather, soil and sensor data on Spark."""
