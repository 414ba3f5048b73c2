"""Composite analyses (the task's pipeline entry points) and the query catalog."""
