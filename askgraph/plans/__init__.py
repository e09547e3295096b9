"""Whole jobs, and the queries registered for checking."""
