"""feedloom: align tabular feeds to one shared table with Spark DataFrames.

Every operator takes and returns DataFrames; no session is created here.
"""
