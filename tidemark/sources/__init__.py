"""Readers, sinks, partitioned layouts and the synthetic-data generator."""
