"""Whole plans: the sensor view over the test tables, the full report run, the query registry."""
