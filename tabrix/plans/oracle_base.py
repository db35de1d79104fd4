"""DuckDB twins of the input views (same derivation rules as tabrix.sources.fixture)."""

# CTE list (no leading WITH) that defines `campaign` from the pre-registered tables.
CAMPAIGN_CTE = """
li AS (
  SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q,
         max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r,
         max(CASE WHEN l_discount >= 0.10 THEN 1 ELSE 0 END) AS disc
  FROM lineitem GROUP BY l_orderkey),
ow AS (
  SELECT o.*, CAST(o_orderdate AS DATE) AS od,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS prev,
         lag(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS pd,
         lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS ps
  FROM orders o),
campaign AS (
  SELECT o.o_orderkey AS id,
         CAST(18 + (o.o_custkey * 7) % 78 AS INTEGER) AS age,
         c.c_mktsegment AS job, o.o_orderstatus AS marital, r.r_name AS education,
         CASE WHEN c.c_acctbal < 0 THEN 'yes' ELSE 'no' END AS "default",
         c.c_acctbal AS balance,
         CASE WHEN li.r = 1 THEN 'yes' ELSE 'no' END AS housing,
         CASE WHEN li.disc = 1 THEN 'yes' ELSE 'no' END AS loan,
         o.o_orderpriority AS contact,
         CAST(day(o.od) AS INTEGER) AS day,
         lower(strftime(o.od, '%b')) AS month,
         CAST(li.q * 10 AS INTEGER) AS duration,
         CAST(coalesce(li.n, 0) AS INTEGER) AS campaign,
         CAST(CASE WHEN o.pd IS NULL THEN -1 ELSE date_diff('day', o.pd, o.od) END AS INTEGER) AS pdays,
         CAST(o.prev AS INTEGER) AS previous,
         CASE WHEN o.ps = 'F' THEN 'success' WHEN o.ps = 'O' THEN 'failure'
              WHEN o.ps = 'P' THEN 'other' ELSE 'unknown' END AS poutcome,
         CAST(CASE WHEN ((coalesce(li.q, 0) > 190 OR (o.ps = 'F' AND coalesce(li.q, 0) > 150))
                    <> (substr(md5(CAST(o.o_orderkey AS VARCHAR)), 1, 1) = '0')) THEN 1 ELSE 0 END AS INTEGER) AS y
  FROM ow o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN li ON o.o_orderkey = li.l_orderkey)
"""

DOCS_CTE = """
docs AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
"""


def with_campaign(*ctes: str) -> str:
    """`WITH <campaign ctes>, <extra ctes>` prefix."""
    parts = [CAMPAIGN_CTE.strip()] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n"
