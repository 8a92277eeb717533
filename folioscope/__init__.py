"""Folioscope: article tables, quality gates, vector indexes and retrieval on Spark."""
