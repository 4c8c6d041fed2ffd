"""DuckDB SQL of the test-data views (same definitions as sources.tables).

Used only to build oracle queries; base tables are pre-registered views.
"""

from __future__ import annotations

VIEWS = {
    "actor_events": """
        SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, o.o_orderdate AS ts,
               c.c_mktsegment AS actor1_type, nullif(l.l_returnflag, 'R') AS actor2_type,
               c.c_nationkey AS actor1_country, s.s_nationkey AS actor2_country,
               1 + (l.l_orderkey + l.l_linenumber) % 4 AS quad_class,
               c.c_nationkey * 7 - 80 AS lat1, c.c_nationkey * 14 - 170 AS long1,
               s.s_nationkey * 7 - 80 AS lat2, s.s_nationkey * 14 - 170 AS long2,
               l.l_linenumber AS root_code, l.l_quantity / 5.0 - 5.0 AS goldstein
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
             JOIN customer c ON o.o_custkey = c.c_custkey
             JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "copurchase": """
        SELECT DISTINCT least(a.l_partkey, b.l_partkey) AS src, greatest(a.l_partkey, b.l_partkey) AS dst
        FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
        WHERE a.l_partkey <> b.l_partkey""",
    "nation_trade": """
        SELECT a AS src, b AS dst
        FROM (SELECT a, b, n, sum(n) OVER () AS total, count(*) OVER () AS pairs
              FROM (SELECT least(c_nationkey, s_nationkey) AS a, greatest(c_nationkey, s_nationkey) AS b, count(*) AS n
                    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
                    JOIN supplier ON l_suppkey = s_suppkey
                    WHERE c_nationkey <> s_nationkey GROUP BY 1, 2) t) t
        WHERE n * pairs >= total""",
    "nation_sides": """
        SELECT src, dst FROM (
          SELECT src, dst, n, sum(n) OVER () AS total, count(*) OVER () AS pairs FROM (
            SELECT c_nationkey AS src, -1 - s_nationkey AS dst, count(*) AS n
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
            JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2) t) t
        WHERE n * pairs >= total""",
    "cust_supp": """
        SELECT o.o_custkey AS cust, l.l_suppkey AS supp, count(*) AS weight
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        GROUP BY 1, 2""",
    "monthly": """
        WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS lo,
                          date_trunc('month', max(o_orderdate)) AS hi FROM orders),
        cal AS (SELECT CAST(gs AS TIMESTAMP) AS ts,
                       CAST(datediff('month', b.lo, gs) AS BIGINT) AS pos
                FROM b, unnest(generate_series(b.lo, b.hi - INTERVAL 1 MONTH,
                                               INTERVAL 1 MONTH)) t(gs)),
        cnt AS (SELECT c.c_nationkey AS series_id, date_trunc('month', o.o_orderdate) AS ts,
                       count(*) AS x
                FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2)
        SELECT n.n_nationkey AS series_id, cal.pos, cal.ts,
               CAST(coalesce(cnt.x, 0) AS DOUBLE) AS x
        FROM nation n CROSS JOIN cal
        LEFT JOIN cnt ON cnt.series_id = n.n_nationkey AND cnt.ts = cal.ts""",
    "daily": """
        SELECT coalesce(a.day, b.day) AS day, a.x, b.y
        FROM (SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS DOUBLE) AS x
              FROM orders GROUP BY 1) a
        FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS y
                   FROM lineitem GROUP BY 1) b ON a.day = b.day""",
    "numeric6": """
        SELECT l.l_quantity AS f1, l.l_extendedprice AS f2, l.l_discount AS f3,
               l.l_tax AS f4, CAST(p.p_size AS DOUBLE) AS f5, p.p_retailprice AS f6
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "points2d": """
        SELECT c_custkey AS id, c_acctbal AS x, CAST(c_nationkey AS DOUBLE) AS y
        FROM customer""",
    "doc_class": """
        SELECT d.doc_id, d.text, d.lang, d.n_chars, l.quality, l.toxic
        FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
}


def with_views(names, body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with CTEs for the named views and extra (name, sql) pairs."""
    ctes = [(n, VIEWS[n]) for n in names] + list(extra or [])
    if not ctes:
        return body
    head = "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes)
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return head + ",\n" + stripped[5:]
    return head + "\n" + body
