"""Trip, trade and ride-stream analytics as plain PySpark DataFrame functions.

``sources`` read files and topics, ``functions`` hold column expressions, ``operators`` turn
DataFrames into DataFrames, ``sinks`` write tables, ``streaming`` holds the ride-stream jobs and
``plans`` the named queries with their check SQL.
"""
