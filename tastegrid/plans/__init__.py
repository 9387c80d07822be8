"""Whole jobs, and the queries registered over the test tables."""
