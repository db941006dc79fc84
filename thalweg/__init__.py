"""Daily hydrological time series on Spark: cleaning, features, forecasts and flood alerts.

Every operator takes and returns DataFrames.  Two ideas run through the package:

*Raw tables are reduced before they are ordered.*  A raw table may hold any number of rows for one
location; it is brought to one row per (location, day) with an aggregate that combines on the map
side.  From there on a location's series can hold no more rows than the calendar has days, so the
windows of ``operators.series`` work on groups of a known bound whatever the size of the input.

*The clock is an argument.*  Nothing reads the current date; jobs take ``as_of``.
"""
