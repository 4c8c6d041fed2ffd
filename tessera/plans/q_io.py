"""Registered source/sink round trips (IO*) and the streaming query (ST1).

Each query writes a table derived from the test data into a fresh folder
under the shared checkpoint folder, reads it back with the reader under
test and returns what it read.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.plans.catalog import query
from tessera.plans.views_sql import VIEWS
from tessera.sources import io as IO
from tessera.sources import tables as TB
from tessera.streaming import events as ST

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType())])


@query("IO1_csv_roundtrip", "SELECT * FROM orders")
def io1(spark, sf):
    path = IO.write_delimited(TB.table(spark, sf, "orders"), IO.scratch_path(spark, "csv"))
    return IO.read_delimited(spark, path, ORDERS_SCHEMA)


@query("IO2_raw_events_tsv", "SELECT event_id, ts, user_id, event_type, value FROM events")
def io2(spark, sf):
    ev = TB.table(spark, sf, "events").drop("props")
    path = IO.write_delimited(ev, IO.scratch_path(spark, "tsv"), sep="\t", header=False)
    return IO.read_raw_events(spark, path, ["event_id", "ts", "user_id", "event_type", "value"],
                              {"event_id": "bigint", "user_id": "bigint", "value": "double"},
                              date_col="ts")


@query("IO3_whitespace_columns",
       "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem")
def io3(spark, sf):
    li = TB.table(spark, sf, "lineitem")
    line = F.concat_ws("   ", *[F.col(c).cast("string") for c in
                                ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")])
    path = IO.scratch_path(spark, "ws")
    li.select(F.concat(F.lit("  "), line).alias("value")).write.text(path)
    return IO.read_whitespace(spark, path, ["l_orderkey", "l_linenumber", "l_quantity",
                                            "l_extendedprice"],
                              ["bigint", "int", "double", "double"])


@query("IO4_header_footer_series", """
SELECT date_trunc('month', o_orderdate) AS month, CAST(count(*) AS DOUBLE) AS total
FROM orders GROUP BY 1""")
def io4(spark, sf):
    m = (TB.table(spark, sf, "orders").groupBy(F.date_trunc("month", "o_orderdate").alias("m"))
         .agg(F.count(F.lit(1)).alias("n")))
    body = m.select(F.lit(1).alias("k"), F.col("m"),
                    F.concat_ws(",", F.date_format("m", "yyyy-MM"), F.col("n").cast("string"))
                    .alias("value"))
    head = spark.createDataFrame([(0, None, "Month,Total orders")], "k int, m timestamp, value string")
    foot = spark.createDataFrame([(2, None, ""), (3, None, "Orders per month, all customers")],
                                 "k int, m timestamp, value string")
    path = IO.scratch_path(spark, "series")
    # one small file (one line per month); header and footer around the body
    (head.unionByName(body.select("k", F.col("m").cast("timestamp"), "value")).unionByName(foot)
     .orderBy("k", "m").coalesce(1).select("value").write.text(path))
    r = IO.read_series_csv(spark, path, "month", "total", "yyyy-MM")
    return r


EV_NAMES = ["event_id", "ts", "user_id", "event_type", "value"]


@query("IO5_read_time_slots", """
SELECT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M%S') AS slot, count(*) AS n,
       round(sum(value), 6) AS value
FROM events
WHERE time_bucket(INTERVAL 15 MINUTE, ts) BETWEEN TIMESTAMP '2024-01-02 10:00:00'
                                              AND TIMESTAMP '2024-01-02 12:00:00'
GROUP BY 1""")
def io5(spark, sf):
    ev = TB.table(spark, sf, "events").drop("props")
    root = IO.write_slots(ev, IO.scratch_path(spark, "slots"), "ts")
    df = IO.read_slots(spark, root, EV_NAMES, "2024-01-02 10:00:00", "2024-01-02 12:00:00")
    return df.groupBy("slot").agg(F.count(F.lit(1)).alias("n"),
                                  F.round(F.sum(F.col("value").cast("double")), 6).alias("value"))


@query("IO6_slot_file_names", """
WITH b AS (SELECT time_bucket(INTERVAL 15 MINUTE, min(ts)) AS lo, max(ts) AS hi FROM events)
SELECT CAST(s AS TIMESTAMP) AS slot,
       strftime(s, '%Y%m%d%H%M%S') || '.translation.export.CSV.zip' AS file_name
FROM b, unnest(generate_series(lo, hi, INTERVAL 15 MINUTE)) t(s)""")
def io6(spark, sf):
    return IO.name_slots(IO.slots_covering(TB.table(spark, sf, "events"), "ts"), "events")


@query("IO7_partitioned_parquet", """
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM orders
WHERE year(o_orderdate) = 1996""")
def io7(spark, sf):
    o = TB.table(spark, sf, "orders").select("o_orderkey", "o_totalprice",
                                             F.year("o_orderdate").alias("o_year"))
    path = IO.save_table(o, IO.scratch_path(spark, "parquet"), ["o_year"])
    return IO.load_table(spark, path).filter(F.col("o_year") == 1996).select(
        "o_orderkey", "o_totalprice", "o_year")


@query("IO8_code_book", """
SELECT r.r_name AS family, 'nations' AS level, CAST(n.n_nationkey AS VARCHAR) AS code,
       n.n_name AS label
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT 'REGIONS', NULL, CAST(r_regionkey AS VARCHAR), r_name FROM region""")
def io8(spark, sf):
    n = TB.table(spark, sf, "nation")
    r = TB.table(spark, sf, "region")
    per = (n.join(r, n.n_regionkey == r.r_regionkey).groupBy("r_name")
           .agg(F.map_from_entries(F.collect_list(F.struct(
               F.col("n_nationkey").cast("string"), F.col("n_name")))).alias("m")))
    fam = per.select(F.concat(F.regexp_replace(F.to_json(F.array("r_name")), r"^\[|\]$", ""),
                              F.lit(": "), F.to_json(F.create_map(F.lit("nations"), F.col("m"))))
                     .alias("entry"))
    reg = r.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(
        F.col("r_regionkey").cast("string"), F.col("r_name"))))).alias("m"))
    reg = reg.select(F.concat(F.lit('"REGIONS": '), F.col("m")).alias("entry"))
    doc = (fam.unionByName(reg).agg(F.concat(F.lit("{\n"), F.concat_ws(",\n", F.collect_list(
        "entry")), F.lit("\n}")).alias("value")))
    path = IO.scratch_path(spark, "json")
    doc.coalesce(1).write.text(path)
    return IO.read_code_book(spark, path)


@query("IO9_graph_files", f"SELECT src, dst FROM ({VIEWS['copurchase']}) g")
def io9(spark, sf):
    path = IO.write_delimited(TB.copurchase(spark, sf), IO.scratch_path(spark, "graph"))
    e, _ = IO.read_graph(spark, path)
    return e


@query("IO10_take_corpus", """
SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr') ORDER BY doc_id LIMIT 100""")
def io10(spark, sf):
    return IO.take_corpus(TB.table(spark, sf, "documents").select("doc_id", "lang"),
                          ["en", "fr"], 100, "lang", "doc_id")


@query("ST1_stream_window_counts", """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
       event_type, count(*) AS n
FROM events GROUP BY 1, 2, 3""")
def st1(spark, sf):
    """Events land in four batches by time; the query runs after each of them,
    resuming from its checkpoint, and once more after the closing row."""
    ev = TB.table(spark, sf, "events").select(*ST.EVENT_NAMES)
    landing, out, state = (IO.scratch_path(spark, x) for x in ("landing", "stream-out", "stream-ckpt"))
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    steps = [lo + (hi - lo) * k / 4 for k in range(1, 4)]
    for a, b in zip([None, *steps], [*steps, None]):
        part = ev if a is None else ev.filter(F.col("ts") >= F.lit(a))
        IO.write_delimited(part if b is None else part.filter(F.col("ts") < F.lit(b)), f"{landing}/{IO.uuid.uuid4().hex[:8]}",
                           sep="\t", header=False)
        ST.run_window_counts(spark, f"{landing}/*", out, state)
    ST.close_windows(spark, f"{landing}/closing", str(hi + datetime.timedelta(days=1)))
    out = ST.run_window_counts(spark, f"{landing}/*", out, state)
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                      "event_type", "n")
