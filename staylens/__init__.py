"""staylens: short-stay marketplace analytics as Spark DataFrame operators.

Every listing operator is a plain function ``DataFrame(s) -> DataFrame`` built
only from native Spark expressions, so Catalyst sees (and optimises) the whole
query: no RDDs, no Python UDFs, no driver-side collection inside an operator.

Sub-packages
------------
functions  column expressions (money parsing, case folding, tokenising, haversine)
sources    schemas, TSV / GeoJSON readers, delimited writers, test-table adapters
operators  the query-level operators (profile, pricing, hosts, guests, spatial,
           terms, alternatives)
plans      reusable plan shapes (top-k per group, scalar subqueries) and the
           registry of runnable queries with their DuckDB SQL oracles
llm        operators for language-model training text (optional; see its docstring)
"""

__version__ = "0.1.0"
