"""DuckDB oracle SQL for the registered queries.

Each string runs on DuckDB with the driver's tables registered as views.  The fixture
CTEs below mirror ``tessera.sources.fixtures`` (same injections, same md5 test cut).
Doubles are rounded to 6 places on both sides.
"""

from __future__ import annotations

F1 = """
f1 AS (
  WITH pre AS (
    SELECT o_custkey,
           sum(o_totalprice) AS total_charges,
           min(o_orderdate) AS first_order,
           max(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent,
           max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS fulfilled
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-08-01 00:00:00' GROUP BY o_custkey),
  post AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-08-01 00:00:00')
  SELECT c.c_custkey AS id,
         CASE WHEN c.c_custkey % 13 = 0 THEN NULL
              WHEN md5(concat('split|', CAST(c.c_custkey AS VARCHAR))) < '33' AND c.c_custkey % 41 = 5 THEN 'UNSEEN'
              WHEN c.c_custkey % 331 = 1 THEN 'SHIPYARD'
              WHEN c.c_custkey % 97 = 2 THEN concat(c.c_mktsegment, 'S')
              ELSE c.c_mktsegment END AS segment,
         n.n_name AS nation, r.r_name AS region,
         CASE WHEN pre.urgent = 1 THEN 'Yes' ELSE 'No' END AS urgent,
         CASE WHEN pre.fulfilled = 1 THEN 'Yes' ELSE 'No' END AS fulfilled,
         CASE WHEN c.c_custkey % 11 = 0 THEN NULL ELSE c.c_acctbal END AS acctbal,
         CAST(24008 - (year(pre.first_order) * 12 + month(pre.first_order)) AS BIGINT) AS tenure,
         CASE WHEN c.c_custkey % 17 = 0 THEN NULL ELSE pre.total_charges END AS total_charges,
         pre.total_charges / (24009 - (year(pre.first_order) * 12 + month(pre.first_order))) AS monthly_charges,
         CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END AS in_debt,
         CASE WHEN post.o_custkey IS NULL THEN 'Yes' ELSE 'No' END AS label,
         md5(concat('split|', CAST(c.c_custkey AS VARCHAR))) < '33' AS is_test
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN pre ON pre.o_custkey = c.c_custkey
  LEFT JOIN post ON post.o_custkey = c.c_custkey),
tr AS (SELECT * FROM f1 WHERE NOT is_test)
"""

F3 = """
f3 AS (
  SELECT event_id AS id,
         CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value,
         CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS event_type,
         CASE WHEN event_id % 23 = 0 THEN ' ' ELSE CAST(event_id % 50 AS VARCHAR) END AS raw_number,
         CASE WHEN event_id % 10 = 3 THEN NULL ELSE user_id % 7 END AS user_group,
         md5(concat('split|', CAST(event_id AS VARCHAR))) < '33' AS is_test
  FROM events),
tr3 AS (SELECT * FROM f3 WHERE NOT is_test)
"""

F4 = """
f4 AS (
  SELECT d.doc_id AS id, d.lang, d.source,
         CAST(d.n_chars AS DOUBLE) AS n_chars,
         CAST(length(d.text) - length(replace(d.text, ' ', '')) AS DOUBLE) AS n_spaces,
         CAST(length(d.text) - length(replace(d.text, '.', '')) AS DOUBLE) AS n_dots,
         l.toxic, l.quality
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""

F5 = """
f5 AS (
  SELECT f1.*,
         CASE WHEN (id * 7919) % 1000
                   < 100 + 500 * in_debt + CASE WHEN urgent = 'No' THEN 200 ELSE 0 END
              THEN 1 ELSE 0 END AS planted
  FROM f1),
tr5 AS (SELECT * FROM f5 WHERE NOT is_test)
"""


SIG = 9


def sig(x: str) -> str:
    """SQL twin of catalog.r6: round to SIG significant digits."""
    x = f"CAST(({x}) AS DOUBLE)"
    e = f"floor(log10(abs({x})))"
    p = f"pow(10.0, abs({e}))"
    k = f"{float(10 ** (SIG - 1))!r}"
    return (f"(CASE WHEN {x} IS NULL OR {x} = 0 THEN {x} "
            f"WHEN {e} >= 0 THEN floor({x} / {p} * {k} + 0.5) / {k} * {p} "
            f"ELSE floor({x} * {p} * {k} + 0.5) / {k} / {p} END)")


def _with(parts: list[str], select: str, ctes: str = "") -> str:
    head = ",\n".join(parts + ([ctes] if ctes.strip() else []))
    return "WITH " + head + "\n" + select


def f1_sql(select: str, ctes: str = "") -> str:
    return _with([F1], select, ctes)


def f3_sql(select: str, ctes: str = "") -> str:
    return _with([F3], select, ctes)


def f4_sql(select: str, ctes: str = "") -> str:
    return _with([F4], select, ctes)


def f5_sql(select: str, ctes: str = "") -> str:
    return _with([F1, F5], select, ctes)
