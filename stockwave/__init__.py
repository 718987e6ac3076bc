"""stockwave: retail demand and replenishment analytics on Spark DataFrames."""

__version__ = "0.1.0"
