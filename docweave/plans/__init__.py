"""Whole dataflows, plug-ins, named queries and their SQL."""
