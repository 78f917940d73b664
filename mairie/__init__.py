"""Municipality-level election and socio-economic analytics on Spark.

Raw delimited files become typed silver tables, silver tables become one gold
row per municipality and election year, and the gold table feeds MLlib models
and a catalogue of report questions.  Every operator takes DataFrames and
column names, so the same code runs on any table with the right columns.
"""
