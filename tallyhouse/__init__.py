"""Warehouse modelling, access policy and usage reporting as PySpark DataFrame operators."""
