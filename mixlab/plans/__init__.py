"""Composed flows and the queries registered with the driver."""
