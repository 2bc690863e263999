"""Roster backfill and reconciliation on Spark DataFrames."""
