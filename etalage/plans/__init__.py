"""Compositions of the operators: the daily run, the retail view of the star schema, the queries."""
