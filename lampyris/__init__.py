"""Lampyris: LLM and agent telemetry analytics on PySpark.

Every operator is a function from DataFrames to a DataFrame built from Spark
SQL expressions; batch jobs and Structured Streaming share the same functions.
"""
