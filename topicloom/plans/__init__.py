"""Whole jobs over dated tables, and the query catalogue over the test tables."""
