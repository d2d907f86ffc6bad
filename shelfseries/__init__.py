"""Retail time-series analytics on Spark DataFrames.

Every public function takes and returns DataFrames. Time-series functions take
``keys``: the columns that identify one series. ``keys=()`` means one series.
"""
