"""Tallywick: trust-graph analytics and large-table data processing on PySpark."""

__version__ = "0.1.0"
