"""Test-data forms of the report's operators (queries q01-q23).

``forms.QUERIES`` are the Spark forms over the analog views of the test
tables; ``oracle.SQL`` gives each one in DuckDB SQL, written in the
original's style (correlated subqueries, UPDATE-as-join) rather than the
Spark plan's.
"""
