"""Spark-first table analytics and model preparation.

Every operation takes DataFrames and returns DataFrames; fitted models are
ordinary ``pyspark.ml`` models.  See the README for the layout.
"""
