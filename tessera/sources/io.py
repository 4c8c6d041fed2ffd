"""Readers and writers (IO1--IO10).

Every reader takes an explicit schema (no inference).  Scratch output of the
round-trip queries goes below the session's checkpoint folder, which is the
shared storage named by ``spark.checkpoint.dir`` on a cluster.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import checkpoint_dir

# Table kinds of the news-event feed -> file-name part, key
# column, date column; file name = <yyyyMMddHHmmss>.translation.<part>.CSV.zip
TABLE_KINDS = {
    "events": ("export", "GLOBALEVENTID", "DATEADDED"),
    "gkg": ("gkg", None, "V2.1DATE"),
    "mentions": ("mentions", "GLOBALEVENTID", "EVENTTIMEDATE"),
}
SLOT_FORMAT = "yyyyMMddHHmmss"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the (shared) checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/io-{name}-{uuid.uuid4().hex[:12]}"


# ------------------------------------------------------------ IO1 / IO2 / IO3 / IO4

#: Timestamps are written with all their microseconds.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True) -> str:
    (df.write.mode("overwrite").option("sep", sep).option("header", header)
     .option("timestampFormat", TIME_FORMAT).option("timestampNTZFormat", TIME_FORMAT).csv(path))
    return path


def read_delimited(spark: SparkSession, path, schema, sep: str = ",", header: bool = True,
                   encoding: str = "UTF-8") -> DataFrame:
    """IO1: delimited text with an explicit schema."""
    return (spark.read.schema(schema).option("sep", sep).option("header", header)
            .option("encoding", encoding).option("mode", "PERMISSIVE").csv(path))


def read_raw_events(spark: SparkSession, path, names, casts: dict, date_col: str | None = None,
                    date_format: str | None = None, sep: str = "\t") -> DataFrame:
    """IO2: headerless separated text, every column read as string, then
    cast late (``try_cast``; bad values become null); ``date_col`` parsed
    with ``date_format`` (or the default timestamp syntax)."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = read_delimited(spark, path, schema, sep=sep, header=False)
    cols = []
    for n in names:
        if n == date_col:
            c = (F.to_timestamp_ntz(F.col(n), F.lit(date_format)) if date_format
                 else F.expr(f"try_cast(`{n}` AS timestamp_ntz)"))
        elif n in casts:
            c = F.expr(f"try_cast(`{n}` AS {casts[n]})")
        else:
            c = F.col(n)
        cols.append(c.alias(n))
    return raw.select(*cols)


def read_whitespace(spark: SparkSession, path, names, types) -> DataFrame:
    """IO3: columns separated by runs of white space."""
    parts = F.split(F.trim(F.col("value")), r"\s+")
    t = spark.read.text(path).filter(F.trim(F.col("value")) != "")
    return t.select(*[parts[i].cast(ty).alias(n) for i, (n, ty) in enumerate(zip(names, types))])


def read_series_csv(spark: SparkSession, path, ts_col: str, value_col: str, ts_format: str,
                    value_type: str = "double") -> DataFrame:
    """IO4: a CSV with a header and footer lines: keep the rows whose key
    parses as a timestamp (same effect as skipping header/footer rows, with
    no row numbers)."""
    schema = T.StructType([T.StructField(ts_col, T.StringType()),
                           T.StructField(value_col, T.StringType())])
    raw = read_delimited(spark, path, schema, header=False)
    ts = F.try_to_timestamp(F.col(ts_col), F.lit(ts_format))
    return raw.select(ts.cast("timestamp_ntz").alias(ts_col),
                      F.expr(f"try_cast(`{value_col}` AS {value_type})").alias(value_col)
                      ).filter(F.col(ts_col).isNotNull())


# ------------------------------------------------------------ IO5 / IO6 time slots

def slots(spark: SparkSession, start: str, end: str, step: str = "15 minutes") -> DataFrame:
    """Every slot from ``start`` to ``end`` inclusive."""
    return spark.range(1).select(F.explode(F.expr(
        f"sequence(timestamp_ntz'{start}', timestamp_ntz'{end}', interval {step})")).alias("slot"))


def slot_files(spark: SparkSession, kind: str, start: str, end: str,
               step: str = "15 minutes") -> DataFrame:
    """IO6: expected file name per slot for a table kind."""
    return name_slots(slots(spark, start, end, step), kind)


def name_slots(slot_df: DataFrame, kind: str, slot: str = "slot") -> DataFrame:
    part, _, _ = TABLE_KINDS[kind]
    return slot_df.select(slot, F.concat(F.date_format(slot, SLOT_FORMAT),
                                         F.lit(f".translation.{part}.CSV.zip")).alias("file_name"))


def slots_covering(df: DataFrame, ts: str, step_minutes: int = 15) -> DataFrame:
    """Slots from the one holding the first row to the last row's time,
    derived from a one-row min/max aggregate (no driver round trip)."""
    secs = step_minutes * 60
    b = df.agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    lo = F.expr(f"timestamp_seconds(floor(unix_micros(cast(_lo AS timestamp)) / "
                f"{secs * 1000000}) * {secs})").cast("timestamp_ntz")
    return b.select(F.explode(F.sequence(lo, F.col("_hi").cast("timestamp_ntz"),
                                         F.expr(f"interval {step_minutes} minutes"))).alias("slot"))


def write_slots(df: DataFrame, path: str, ts: str, step_minutes: int = 15, sep: str = "\t") -> str:
    """Land a table as one folder per time slot (``slot=<yyyyMMddHHmmss>``)."""
    slot = F.date_format(F.window(ts, f"{step_minutes} minutes").start, SLOT_FORMAT)
    (df.withColumn("slot", slot).write.mode("overwrite").partitionBy("slot")
     .option("sep", sep).option("header", False).csv(path))
    return path


def read_slots(spark: SparkSession, root: str, names, start: str, end: str,
               sep: str = "\t") -> DataFrame:
    """IO5: append all slot folders from ``start`` to ``end`` (inclusive);
    the slot filter prunes folders before any file is opened."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names]
                          + [T.StructField("slot", T.StringType())])
    df = (spark.read.schema(schema).option("sep", sep).option("header", False)
          .option("basePath", root).csv(root))
    lo = start.replace("-", "").replace(" ", "").replace(":", "")
    hi = end.replace("-", "").replace(" ", "").replace(":", "")
    return df.filter((F.col("slot") >= lo) & (F.col("slot") <= hi))


# ------------------------------------------------------------ IO7 save / load

def save_table(df: DataFrame, path: str, partition=()) -> str:
    w = df.write.mode("overwrite")
    if partition:
        w = w.partitionBy(*partition)
    w.parquet(path)
    return path


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ------------------------------------------------------------ IO8 nested code book

def read_code_book(spark: SparkSession, path: str) -> DataFrame:
    """IO8: nested JSON object ``family -> [level ->] code -> label`` as rows
    ``(family, level, code, label)``; a family without levels gets a null
    level.  Nested objects are read as JSON strings level by level."""
    raw = spark.read.text(path, wholetext=True)
    fam = raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("family", "v"))
    nested = F.from_json("v", "map<string,string>")
    lvl = fam.select("family", F.explode(nested).alias("k", "v2"))
    is_obj = F.trim(F.col("v2")).startswith("{")
    two = (lvl.filter(is_obj).select("family", F.col("k").alias("level"),
                                     F.explode(F.from_json("v2", "map<string,string>"))
                                     .alias("code", "label")))
    one = lvl.filter(~is_obj).select("family", F.lit(None).cast("string").alias("level"),
                                     F.col("k").alias("code"), F.col("v2").alias("label"))
    return two.unionByName(one)


# ------------------------------------------------------------ IO9 graph files

def read_graph(spark: SparkSession, edges_path: str, nodes_path: str | None = None,
               id_type: str = "bigint", weighted: bool = False):
    """IO9: edge list ``src,dst[,weight]`` (+ optional node table) from CSV."""
    fields = [T.StructField("src", T.StringType()), T.StructField("dst", T.StringType())]
    if weighted:
        fields.append(T.StructField("weight", T.StringType()))
    e = read_delimited(spark, edges_path, T.StructType(fields))
    e = e.select(F.col("src").cast(id_type).alias("src"), F.col("dst").cast(id_type).alias("dst"),
                 *([F.col("weight").cast("double").alias("weight")] if weighted else []))
    nodes = None
    if nodes_path:
        nodes = spark.read.option("header", True).csv(nodes_path)
        nodes = nodes.withColumn("id", F.col("id").cast(id_type))
    return e, nodes


# ------------------------------------------------------------ IO10 corpus

def take_corpus(df: DataFrame, classes, n: int, class_col: str, order_col: str) -> DataFrame:
    """IO10: rows of the given classes, the first ``n`` in key order (a
    sampling step by definition; TakeOrderedAndProject keeps it top-k)."""
    return df.filter(F.col(class_col).isin(list(classes))).orderBy(order_col).limit(n)
