"""Irregular sensor and event streams to fixed-rate episodes, and audits of them, on PySpark."""
