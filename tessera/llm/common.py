"""Helpers shared by the operators of this subpackage.

Operators take a DataFrame and the names of the columns they read; they select
just those, so further columns (whatever their names) never reach the work.
"""

from __future__ import annotations

import ctypes
import gc
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.session import cut_lineage

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def tidy() -> None:
    """Gives memory that a task no longer needs back to the system: its worker
    lives on, idle, beside those of later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_texts(df: DataFrame, fn: Callable, schema: str, piece: int = 4 << 20, raw: bool = False) -> DataFrame:
    """``fn(*columns as lists) -> {column: list or array}`` over the rows, in
    pieces of about ``piece`` bytes, so that a task holds little beyond its Arrow
    batch; ``raw`` passes the columns as Arrow arrays."""
    shape = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn() if getattr(fn, "factory", False) else fn
        for b in batches:
            at = 0
            while at < b.num_rows:
                n = max(1, int((b.num_rows - at) * min(1.0, piece / max(1, b.slice(at).nbytes))))
                part = b.slice(at, n)
                while n > 1 and part.nbytes > 2 * piece:      # rows of very unlike sizes
                    n //= 2
                    part = b.slice(at, n)
                at += n
                out = work(*[c if raw else c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_pydict(
                    {f.name: out[f.name].cast(f.type) if isinstance(out[f.name], pa.Array) else out[f.name]
                     for f in shape}, shape)
                del out, part
        work = b = None
        tidy()
    small_batches(df)
    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, column: str, fn: Callable) -> DataFrame:
    """The rows of ``df`` that ``fn(values of the column) -> list of bool`` keeps,
    with all their columns; ``fn`` may be a factory.  Only the column goes to Python,
    only truth values come back; the rows themselves stay in the JVM."""
    @F.arrow_udf("boolean")
    def kept(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keep = fn() if getattr(fn, "factory", False) else fn
        for values in batches:
            out = []
            for k in range(0, len(values), 256):
                out += keep(values.slice(k, 256).to_pylist())
            yield pa.array(out, pa.bool_())
        keep = values = None
        tidy()
    small_batches(df)
    return df.where(kept(df[column]))


def small_batches(df: DataFrame, rows: int = 2000) -> None:
    """Lets Arrow batches of texts have no more than ``rows`` rows from now on, so
    that the copies of a batch on both sides stay small."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(name)) <= rows:
        df.sparkSession.conf.set(name, rows)


def bounded_sample(rows: DataFrame, n: int, *cols: str) -> DataFrame:
    """At most ``n`` rows, those with the smallest hashes of ``cols``; the same
    for the same rows.  Rows far from that are left out by their hash before the
    sort, so tasks send about 1.5 n rows together."""
    total = rows.count()
    hashed = F.pmod(F.xxhash64(*cols), F.lit(1 << 31))
    if total > 2 * n:
        rows = rows.where(hashed < int((1 << 31) * 1.5 * n / total))
    return rows.orderBy(hashed, *cols).limit(n)


def shares(counts: dict, n: int) -> dict:
    """How many of each key's rows to take, at most ``n`` together: all of the
    rarer keys, and as many of each of the others."""
    out = {}
    for k, key in enumerate(sorted(counts, key=lambda key: (counts[key], str(key)))):
        out[key] = min(counts[key], (n - sum(out.values())) // (len(counts) - k))
    return out


def bounded_samples(rows: DataFrame, n: int, key: str, *cols: str) -> list[Row]:
    """At most ``n`` different rows, shared out among the values of ``key``: of
    each those with the smallest hashes of ``cols`` (``key`` is one of them), by
    hash; the same for the same rows, however often each is repeated.  Tasks send
    about 1.5 n rows together."""
    rows = rows.select(*cols).withColumn("__hash", F.xxhash64(*cols))
    counts = {r[0]: r[1] for r in rows.select(key, "__hash").distinct().groupBy(key).count().collect()}
    left, low = shares(counts, n), F.lit(False)
    for value, total in counts.items():
        low |= F.col(key).eqNullSafe(F.lit(value)) & (
            F.pmod("__hash", F.lit(1 << 31)) < min(1 << 31, int((1 << 31) * (1.5 * left[value] + 50) / total)))
    out = []
    for r in sorted(rows.where(low).distinct().collect(), key=lambda r: (r["__hash"] % (1 << 31), *map(str, r))):
        if left[r[key]] > 0:
            left[r[key]] -= 1
            out.append(r)
    return out


class Shared:
    """A value broadcast to the tasks, its classes by value like all code here."""

    def __init__(self, spark: SparkSession, value):
        self.sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.sent.value)


def factory(fn):
    """Marks ``fn`` as making the batch function, once per task."""
    fn.factory = True
    return fn


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class ShingleHasher:
    """64-bit hashes of the w-word shingles of a text, whole texts always."""

    def __init__(self, width: int, words: Callable[[str], list]):
        import xxhash
        self.width, self.words, self.hash = width, words, xxhash.xxh64_digest
        self.factors = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        """Hashes in text order, repeats included; one of the whole sequence if
        it is shorter than a shingle, none without words."""
        ws = self.words(text) if text else []
        if not ws:
            return np.empty(0, np.uint64)
        a = np.frombuffer(b"".join(map(self.hash, ws)), ">u8").astype(np.uint64)
        k = min(self.width, len(a))
        m = len(a) - k + 1
        out = a[:m] * self.factors[0] + np.uint64(k)
        for j in range(1, k):
            out += a[j:j + m] * self.factors[j]
        return mix64(out)


def ascii_words(text: str) -> list[bytes]:
    """Runs of anything but the six ASCII white-space characters, A-Z lower-cased."""
    return text.encode().lower().split()


def join_unique(rows: DataFrame, small: DataFrame, key: str, size: str, heavy: int = 1000) -> DataFrame:
    """``rows`` left-joined with ``small``, which has one row per ``key`` and in
    ``size`` the number of rows that have it.

    Keys of more than a ``heavy``-th of all rows, so fewer than ``heavy`` keys,
    are joined by broadcast; no other key brings more than that many rows to a task.
    """
    small = cut_lineage(small)
    limit = small.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] // heavy
    hot = small.where(F.col(size) > limit).select(F.col(key).alias("__key"), F.lit(True).alias("__hot"), *[
        F.col(c).alias(f"__{c}") for c in small.columns if c != key])
    got = rows.join(F.broadcast(hot), F.col(key) == F.col("__key"), "left")
    others = [c for c in small.columns if c != key]
    found = got.where("__hot").select(*rows.columns, *[F.col(f"__{c}").alias(c) for c in others])
    rest = got.where("__hot is null").select(*rows.columns)
    return found.union(rest.join(small, key, "left").select(*rows.columns, *others))


def _stars(e: DataFrame) -> bool:
    """Whether each node is the larger end of one edge, or the smaller end of
    some, but not both."""
    ends = e.select(F.explode(F.array(F.struct(F.col("a").alias("id"), F.lit(0).alias("up")),
                                      F.struct(F.col("b").alias("id"), F.lit(1).alias("up")))).alias("x")).select("x.*")
    odd = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("lo")).where("ups > 1 or (ups = 1 and lo = 0)")
    return odd.isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """(id, root): smallest id reachable over the undirected ``edges`` (a, b).

    Alternating large-star and small-star rounds, each an aggregation by node;
    a hub of any degree is only a grouping key whose minimum combines map-side.
    Lineage is cut each round by a written table.  Ends when every component is
    a star around its least node.
    """
    e = cut_lineage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .where("a <> b").distinct())
    while not _stars(e):
        # large star: every larger neighbour of u is tied to u's least neighbour (or u)
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        big = (both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
               .where("a <> b").distinct())
        # small star: u and its smaller neighbours are tied to the least of them
        low = big.groupBy("b").agg(F.min("a").alias("m"))
        small = big.join(low, "b").select(F.col("m").alias("x"), "a", "b")
        e = cut_lineage(small.select(F.col("x").alias("a"), F.explode(F.array("a", "b")).alias("b"))
                        .where("a <> b").distinct())
    return e.select(F.col("b").alias("id"), F.col("a").alias("root")).union(
        e.select(F.col("a").alias("id"), F.col("a").alias("root")).distinct())
