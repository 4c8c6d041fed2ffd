"""Access to the parquet test tables and the views derived from them.

The views stand in for the inputs of the original analyses (news events,
graphs, monthly series, numeric matrices, documents).  They are defined on
whole tables; nothing is capped or sampled.  The same definitions exist as
DuckDB SQL in ``tessera.plans.views_sql`` for the oracle checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def actor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News-event-like rows: one per line item, actors = customer and supplier."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
         .join(c, F.col("o_custkey") == c.c_custkey)
         .join(s, li.l_suppkey == s.s_suppkey))
    return j.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_orderdate").alias("ts"),
        F.col("c_mktsegment").alias("actor1_type"),
        F.expr("nullif(l_returnflag, 'R')").alias("actor2_type"),
        F.col("c_nationkey").alias("actor1_country"),
        F.col("s_nationkey").alias("actor2_country"),
        (F.lit(1) + (F.col("l_orderkey") + F.col("l_linenumber")) % 4).alias("quad_class"),
        (F.col("c_nationkey") * 7 - 80).alias("lat1"),
        (F.col("c_nationkey") * 14 - 170).alias("long1"),
        (F.col("s_nationkey") * 7 - 80).alias("lat2"),
        (F.col("s_nationkey") * 14 - 170).alias("long2"),
        F.col("l_linenumber").alias("root_code"),
        (F.col("l_quantity") / 5.0 - 5.0).alias("goldstein"),
    )


def _pairs(rows: DataFrame) -> DataFrame:
    """Undirected edges, each once, smaller part first; no loops."""
    return (rows.filter(F.col("a") != F.col("b"))
            .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct())


def copurchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undirected graph of parts on consecutive lines of an order, over all of
    ``lineitem``: at most one edge per line, so it grows in proportion to it."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    nxt = li.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("b"))
    return _pairs(li.withColumnRenamed("l_partkey", "a").join(nxt, ["l_orderkey", "l_linenumber"]))


def path_sources(spark: SparkSession, sf_dir: str, edges: DataFrame | None = None) -> DataFrame:
    """Sources of the path queries, their documented parameter: parts of size 50
    (about one in fifty) that are nodes of ``copurchase``.  Paths from
    every node would be a row for each pair of nodes.  ``edges`` are those of
    ``copurchase``, if they are at hand."""
    e = copurchase(spark, sf_dir) if edges is None else edges
    parts = table(spark, sf_dir, "part").filter("p_size = 50").select(F.col("p_partkey").alias("id"))
    return e.select(F.explode(F.array("src", "dst")).alias("id")).distinct().join(parts, "id", "left_semi")


def nation_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undirected graph of nations: two nations are linked if they share at
    least as many line items (customer in one, supplier in the other) as trading
    pairs of nations do on average.  Every line item between two nations counts,
    and the nodes are so few at any size that paths start from all of them."""
    pairs = (actor_events(spark, sf_dir).filter(F.col("actor1_country") != F.col("actor2_country"))
             .groupBy(F.least("actor1_country", "actor2_country").alias("src"),
                      F.greatest("actor1_country", "actor2_country").alias("dst"))
             .agg(F.count(F.lit(1)).alias("n")))
    mean = pairs.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("pairs"))
    return (pairs.crossJoin(F.broadcast(mean)).filter(F.col("n") * F.col("pairs") >= F.col("total"))
            .select("src", "dst"))


def nation_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bipartite graph of nations as customers (0, 1, ..) and as suppliers
    (-1, -2, ..), linked by at least the mean number of line items of the pairs."""
    pairs = (actor_events(spark, sf_dir).groupBy(F.col("actor1_country").alias("src"), (-1 - F.col("actor2_country")).alias("dst"))
             .agg(F.count(F.lit(1)).alias("n")))
    mean = pairs.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("pairs"))
    return (pairs.crossJoin(F.broadcast(mean)).filter(F.col("n") * F.col("pairs") >= F.col("total"))
            .select("src", "dst"))


def cust_supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bipartite customer -- supplier graph, weight = number of line items."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").alias("cust"), F.col("l_suppkey").alias("supp"))
            .agg(F.count(F.lit(1)).alias("weight")))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per month per customer nation on the full month calendar.

    ``series_id`` = nation, ``pos`` = month index from the first month,
    ``x`` = order count (0 for a month without orders).  The last, partial
    month is dropped.  The calendar is tiny (one row per month) and built
    from a one-row min/max aggregate, so the cross product with the
    series keys is bounded by months x nations.
    """
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    counts = (o.join(c, o.o_custkey == c.c_custkey)
              .groupBy(F.col("c_nationkey").alias("series_id"),
                       F.date_trunc("month", "o_orderdate").alias("ts"))
              .agg(F.count(F.lit(1)).alias("x")))
    bounds = o.agg(F.date_trunc("month", F.min("o_orderdate")).alias("lo"),
                   F.date_trunc("month", F.max("o_orderdate")).alias("hi"))
    cal = bounds.select(F.posexplode(F.expr(
        "sequence(lo, hi - interval 1 month, interval 1 month)")).alias("pos", "ts"))
    cal = cal.select(F.col("pos").cast("bigint").alias("pos"),
                     F.col("ts").cast("timestamp_ntz").alias("ts"))
    keys = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("series_id"))
    grid = keys.crossJoin(F.broadcast(cal))
    return (grid.join(counts, ["series_id", "ts"], "left")
            .select("series_id", "pos", "ts",
                    F.coalesce(F.col("x"), F.lit(0)).cast("double").alias("x")))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily series: orders per day (x) and shipped quantity per day (y)."""
    o = (table(spark, sf_dir, "orders")
         .groupBy(F.to_date("o_orderdate").alias("day"))
         .agg(F.count(F.lit(1)).cast("double").alias("x")))
    li = (table(spark, sf_dir, "lineitem")
          .groupBy(F.to_date("l_shipdate").alias("day"))
          .agg(F.sum("l_quantity").alias("y")))
    return o.join(li, "day", "full").select("day", "x", "y")


def numeric6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six numeric features per line item (quantity, price, discount, tax,
    part size, part retail price)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_quantity").alias("f1"), F.col("l_extendedprice").alias("f2"),
        F.col("l_discount").alias("f3"), F.col("l_tax").alias("f4"),
        F.col("p_size").cast("double").alias("f5"), F.col("p_retailprice").alias("f6"))


def points2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as 2-d points: (account balance, nation)."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("x"),
        F.col("c_nationkey").cast("double").alias("y"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"),
        "label")


def doc_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    lab = table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id")
