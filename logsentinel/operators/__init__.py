"""Operators: profiling, batch detections, streaming detections, serving."""
