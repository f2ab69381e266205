"""Analyses of logs that keep arriving."""
