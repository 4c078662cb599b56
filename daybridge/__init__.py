"""Partner-data exchange as Spark jobs: exports, landing, financial aggregates, catalogues."""
