"""tidemark — multi-series OHLCV analytics on Spark DataFrames.

Every operator takes a DataFrame of bars keyed by ``series`` (partition key)
and ``bar_ts`` (order key) and returns a DataFrame; nothing is collected to
the driver.  See README.md for the module map.
"""

SERIES = "series"
TS = "bar_ts"
