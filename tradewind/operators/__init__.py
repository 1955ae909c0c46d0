"""DataFrame operators: staging, quality gate, marts, star schema, measures.

Every operator is a function from DataFrames to a DataFrame.  The only actions
are the explicit quality gate and the materialisation of reused grains (written
as parquet in the folder named by ``spark.checkpoint.dir``).
"""
