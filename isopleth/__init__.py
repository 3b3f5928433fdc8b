"""Gridded-field analytics on Spark: fields are long tables, operators are DataFrame -> DataFrame."""

__version__ = "0.1.0"
