"""Mass-spectrometry run quality control on Spark.

Every operator takes DataFrames keyed by ``run_id`` and returns one DataFrame
for all runs; use them directly or through ``DataFrame.transform``.
"""
