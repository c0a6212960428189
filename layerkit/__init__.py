"""Layered lakehouse tables, data-quality routing and star schemas on PySpark."""
