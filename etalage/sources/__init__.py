"""Readers: CSV files under a contract, databases, landed feeds, stages and increments."""
