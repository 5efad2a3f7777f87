"""keystrata: metadata-driven Data Vault loading and reporting on Spark.

Sub-packages
------------
functions   column expressions: hashing, text, time, map projection
operators   DataFrame operators: latest version, column transforms, metadata, merges, counts
sources     files, tables, JDBC: readers, writers and table maintenance
plans       whole jobs composed from the above: vault feed, history, warehouse, calendar, views
catalogue   registered queries, each next to its independent SQL oracle
"""

__version__ = "0.1.0"
