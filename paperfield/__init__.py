"""paperfield: a PySpark library that builds and maintains an index of public web documents.

Everything is a function from DataFrames (or Columns) to DataFrames (or Columns); nothing here
touches the network.  Fetching happens upstream and arrives as a table of captured responses.
"""
