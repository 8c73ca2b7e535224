"""Spark jobs and DataFrame operators for loan applications and call transactions."""

__version__ = "0.1.0"
