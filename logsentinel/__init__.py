"""Security-log analytics on Spark DataFrames.

Detections, scores, rollups and serving queries for network and application
logs, written as parameterised DataFrame functions that run unchanged on a
batch table or a Structured Streaming source.
"""

__version__ = "0.1.0"
