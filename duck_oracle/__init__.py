"""Independent DuckDB SQL for every registered query (the correctness oracle).

The SQL rebuilds the fixture with plain arithmetic (no JSON round trip) and
computes every operator the direct way (correlated subqueries, ORDER BY ...
LIMIT), so it shares no plan shape with the Spark code it checks.
"""
