"""Campaign and conversion analytics expressed as Spark DataFrame operators.

Every operator takes DataFrames, receives its reference time as an argument and returns a
DataFrame. All stored timestamps are ``timestamp_ntz`` holding UTC wall-clock time, so no
result depends on the session time zone.
"""
