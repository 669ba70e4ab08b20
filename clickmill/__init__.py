"""Profiling, encoding and modelling of wide click logs with PySpark."""
