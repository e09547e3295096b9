"""Question-and-answer network analytics, written for Spark.

Raw dumps are cleaned into typed tables, posts become a weighted graph of who
took part in which question, and every user gets the open questions their
direct neighbours were involved in. Every operator takes and returns
DataFrames and is built from Spark's own expressions.
"""
