"""Distributed model building with ``pyspark.ml``: nothing is collected but model metadata."""
