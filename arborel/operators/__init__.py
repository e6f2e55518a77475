"""Operators on feature tables: spatial joins, zonal statistics, graphs, metrics and their roll-up."""
