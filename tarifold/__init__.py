"""Catalog building and price intelligence as Spark DataFrame transformations."""
