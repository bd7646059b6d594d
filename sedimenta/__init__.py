"""Incremental table loading on Spark DataFrames."""

from sedimenta.spec import TableSpec

__all__ = ["TableSpec"]
