"""Flows (lab, warehouse, checks, batch job) and the registered driver-table
queries with their DuckDB oracle SQL."""
