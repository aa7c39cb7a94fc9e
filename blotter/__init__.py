"""blotter: incident analytics on Spark DataFrames.

Sub-packages
------------
functions  column expressions (cleaning, parsing, calendar)
sources    readers for incident documents and call logs, writers for results,
           and adapters that derive incidents/calls from the driver tables
operators  counting/ranking, ordered positions, statistics
plans      the fourteen jobs as parameterised functions, and the query catalog
"""

__all__ = ["functions", "sources", "operators", "plans", "session"]
