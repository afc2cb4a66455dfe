"""Photovoltaic telemetry analytics on Spark: DataFrame in, DataFrame out."""
