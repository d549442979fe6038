"""tidepool — snapshot-lakehouse operators on Spark DataFrames.

Raw payloads land append-only (bronze), are typed (staging), gated for snapshot
completeness, reduced to the best row per key (silver) and rolled up (gold).
Every operator is a ``DataFrame -> DataFrame`` function whose keys, slices and
orderings are parameters; actions happen only in gates, checks and sinks.
"""

__version__ = "0.1.0"
