"""ledgerloom: table operators for daily retail feeds, built on Spark DataFrames.

Layers: CSV deliveries land in an all-string bronze layer with lineage; a quality
split types them into valid and rejected silver rows; gold keeps the latest received
version of each sale and a type-2 store dimension; three reports summarise the result.
Everything is a DataFrame expression, so Catalyst plans it and executors run it.
"""

__version__ = "0.1.0"
