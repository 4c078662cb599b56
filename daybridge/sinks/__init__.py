"""Writes: date partitions, split Parquet, JSON, landing tables, XML catalogues."""
