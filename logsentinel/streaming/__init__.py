"""Structured Streaming runner, sources and the micro-batch alert sink."""
