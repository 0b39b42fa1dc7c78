"""Run-reconstruction analytics on PySpark.

Functions take DataFrames and return lazy DataFrames. ``functions`` holds
column helpers, ``operators`` the DataFrame operators, ``sources`` and ``sinks``
the readers and writers, and ``plans`` the composed runs.
"""
