"""Media-catalogue analytics on Spark DataFrames.

``sources`` reads and writes, ``functions`` are column expressions,
``operators`` are DataFrame-to-DataFrame functions, ``plans`` are whole jobs
built from them.
"""
