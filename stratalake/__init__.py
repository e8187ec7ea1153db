"""Lakehouse analytics as PySpark DataFrame operators, snapshot tables and KPI plans."""
