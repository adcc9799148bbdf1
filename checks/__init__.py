"""Queries over the given test tables, each with the SQL that states its expected result.

The test tables hold no portal responses. Each query turns a whole table into the untidy text
a portal sends, runs the library on it, and the SQL computes the result from the tidy columns.
"""
