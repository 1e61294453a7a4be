"""Inputs, queries and independent SQL for checking the library on the test tables."""
