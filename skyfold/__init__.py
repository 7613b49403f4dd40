"""Daily station observations on Spark: ingest, check, roll up into fact tables.

Layers, lowest first:

``schema``      fixed values and types of the data format
``functions``   Column builders
``sources``     readers (yearly CSV, fixed-width text, partitioned parquet, tables)
``operators``   DataFrame -> DataFrame steps (staging, roll-up, lookup join, quality)
``sinks``       table writers and layouts
``plans``       fact tables and the jobs that build them
"""
