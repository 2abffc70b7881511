"""tripcast: trip-demand analytics on Spark.

Cleans raw trip records, rolls them up to station-hour and area-hour demand,
enriches the fact with calendar, holiday, weather, lag and profile features,
publishes analysis tables, trains and ranks demand models with MLlib and scores
what-if scenarios -- all as DataFrame / SQL / MLlib jobs.
"""

__version__ = "0.1.0"
