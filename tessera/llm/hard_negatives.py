"""Hard-negative mining by segment summaries.

A vector is cut into segments; of each its mean and its deviation (the root of
the summed squares around the mean) are stored.  For segments of n components the
inner product is n * mean * mean' plus something between minus and plus
deviation * deviation' (Cauchy-Schwarz), so summaries bound a score from both
sides.  Two segments' summaries give that of both together, so a pair of vectors
is first bounded by one segment each, then by two, four and so on, as long as
the bounds leave it open whether its score matters; only then are the vectors
multiplied.  Scores are integers and exact.

Anchors go out in blocks of bounded size; rows are read in place, once a block
and pass, and each task sends its best few rows of each anchor.  No group of
rows, by label or otherwise, comes together anywhere, so none can be too large.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Shared, arrow_schema, cut_lineage, map_texts

#: Components of a finest segment.
FINEST = 4
#: Rows whose bounds against a block of anchors are in memory at once.
SLICE = 512
_NONE = np.iinfo(np.int64).min


def width(dim: int) -> int:
    """Components of a padded vector, a power of two of finest segments."""
    return FINEST << max(0, math.ceil(dim / FINEST) - 1).bit_length()


def summaries(ints: np.ndarray) -> np.ndarray:
    """(rows, segments, 2) float32: mean and deviation of the finest segments."""
    x = np.zeros((len(ints), width(ints.shape[1])))
    x[:, :ints.shape[1]] = ints
    x = x.reshape(len(x), -1, FINEST)
    mean = x.mean(2)
    return np.stack([mean, np.sqrt(((x - mean[..., None]) ** 2).sum(2))], 2).astype(np.float32)


def levels(finest: np.ndarray) -> list[np.ndarray]:
    """Per level, from one segment to the finest, (2, rows, segments) of
    sqrt(n) * mean and deviation: sums of their products bound scores."""
    mean, dev, n, out = finest[..., 0].astype(np.float64), finest[..., 1].astype(np.float64), FINEST, []
    while True:
        out.append(np.stack([np.sqrt(n) * mean, dev]))
        if mean.shape[1] == 1:
            return out[::-1]
        a, b = mean[:, ::2], mean[:, 1::2]
        dev = np.sqrt(dev[:, ::2] ** 2 + dev[:, 1::2] ** 2 + n / 2 * (a - b) ** 2)
        mean, n = (a + b) / 2, 2 * n


def norms(level: np.ndarray) -> np.ndarray:
    return np.sqrt((level ** 2).sum((0, 2)))


def slack(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """More than the rounding of summaries can amount to."""
    return 4e-6 * a * b + 1e-3


class Vectors:
    """Vectors of one dimension with the levels of their summaries."""

    def __init__(self, ids, labels, ints: np.ndarray, finest: np.ndarray):
        self.ids, self.labels, self.ints = np.asarray(ids, np.int64), np.asarray(labels, np.int64), ints
        self.levels = levels(finest)
        self.norms = norms(self.levels[-1])
        self.most = int(np.abs(ints).max(initial=0))

    def __len__(self):
        return len(self.ids)


def scores(a: Vectors, b: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact inner products of a[i] and b[j]; more than a long holds raises OverflowError."""
    out, dim = np.empty(len(i), np.int64), a.ints.shape[1]
    exact = a.most * b.most * max(1, dim)
    kind = np.float64 if exact < 1 << 53 else np.int64 if exact < 1 << 63 else object
    if kind is np.float64 and 8 * len(i) > len(a) * len(b):     # most pairs are open: all of them at once are cheaper
        return (a.ints.astype(kind) @ b.ints.T.astype(kind))[i, j].astype(np.int64)
    for at in range(0, len(i), 1 << 15):
        x, y = a.ints[i[at:at + (1 << 15)]].astype(kind), b.ints[j[at:at + (1 << 15)]].astype(kind)
        got = (x * y).sum(1) if kind is object else np.einsum("ij,ij->i", x, y)
        out[at:at + (1 << 15)] = [int(v) for v in got] if kind is object else got.astype(np.int64)
    return out


def open_pairs(a: Vectors, b: Vectors, allowed: np.ndarray, least: np.ndarray, most: np.ndarray | None):
    """Pairs (i, j) of anchors and rows that may score ``least[i]`` or more, and
    ``most[i]`` or less, by bounds refined level by level."""
    i = j = None
    for x, y in zip(a.levels, b.levels):
        if i is None or len(i) * 4 > allowed.size:       # all at once as long as many are open
            mid, spread = x[0] @ y[0].T, x[1] @ y[1].T
            spread += slack(a.norms[:, None], b.norms[None])
            allowed = allowed & (mid + spread >= least[:, None])
            if most is not None:
                allowed &= mid - spread <= most[:, None]
            i, j = np.nonzero(allowed)
            continue
        keep = np.empty(len(i), bool)
        for at in range(0, len(i), 1 << 15):
            p, q = i[at:at + (1 << 15)], j[at:at + (1 << 15)]
            mid = np.einsum("ij,ij->i", x[0][p], y[0][q])
            spread = np.einsum("ij,ij->i", x[1][p], y[1][q]) + slack(a.norms[p], b.norms[q])
            keep[at:at + (1 << 15)] = (mid + spread >= least[p]) & (True if most is None else mid - spread <= most[p])
        i, j = i[keep], j[keep]
    return i, j


class Best:
    """The best few (score, id) of each of ``n`` keys: higher scores first, then
    smaller ids; equal ones count once."""

    def __init__(self, n: int, few: int):
        self.score = np.full((n, few), _NONE)
        self.id = np.zeros((n, few), np.int64)
        self.few = few

    def limit(self) -> np.ndarray:
        """The score that a further one has to reach."""
        return self.score[:, -1]

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        some = np.unique(key)
        key = np.concatenate([np.repeat(some, self.few), key])
        score = np.concatenate([self.score[some].ravel(), score])
        ids = np.concatenate([self.id[some].ravel(), ids])
        real = score > _NONE
        key, score, ids = key[real], score[real], ids[real]
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        key, score, ids = key[new], score[new], ids[new]
        rank = np.arange(len(key)) - key.searchsorted(key)
        top = rank < self.few
        self.score[key[top], rank[top]] = score[top]
        self.id[key[top], rank[top]] = ids[top]

    def rows(self):
        """(key, score, id) of all."""
        k, r = np.nonzero(self.score > _NONE)
        return k, self.score[k, r], self.id[k, r]


class Block:
    """Anchors of one dimension, with the scores of their positives if known."""

    def __init__(self, anchors: Vectors, few: int, positives: np.ndarray | None = None, ratio: tuple[int, int] = (80, 100)):
        self.anchors, self.few = anchors, few
        if positives is not None:                        # (anchors, few), _NONE where there is none
            self.positives, (num, den) = positives, ratio
            real = positives > _NONE
            self.least = np.array([[-(-num * int(s) // den) if r else 0 for s, r in zip(*x)] for x in zip(positives, real)],
                                  np.int64).reshape(positives.shape)
            self.real = real & (self.least <= positives)

    def positive_pairs(self, rows: Vectors, best: Best):
        a = self.anchors
        allowed = (a.labels[:, None] == rows.labels[None]) & (a.ids[:, None] != rows.ids[None])
        i, j = open_pairs(a, rows, allowed, best.limit().astype(np.float64), None)
        s = scores(a, rows, i, j)
        fit = s >= best.limit()[i]
        best.add(i[fit], s[fit], rows.ids[j[fit]])
        return len(i)

    def negative_pairs(self, rows: Vectors, best: Best):
        a, few = self.anchors, self.few
        limit = np.maximum(best.limit().reshape(len(a), few), self.least)
        allowed = (a.labels[:, None] != rows.labels[None]) & self.real.any(1)[:, None]
        least = np.where(self.real, limit, np.inf).min(1)
        i, j = open_pairs(a, rows, allowed, least, np.where(self.real, self.positives, -np.inf).max(1))
        s = scores(a, rows, i, j)
        for k in range(few):
            fit = self.real[i, k] & (s <= self.positives[i, k]) & (s >= limit[i, k])
            best.add(i[fit] * few + k, s[fit], rows.ids[j[fit]])
        return len(i)


def stored(rows: DataFrame, scale: int) -> DataFrame:
    """(id, label, dim, ints, summary): integer components, as wide as a vector
    needs, and the summaries of its finest segments."""
    def work(ids, labels, vectors):
        ints, kept = [], []
        for v in vectors:
            x = np.floor(np.asarray(v, np.float64) * scale)
            if len(x) and np.abs(x).max() >= 2.0 ** 63:
                raise OverflowError("a component does not fit a long")
            x = x.astype(np.int64)
            most = int(np.abs(x).max(initial=0))
            ints.append(x.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8").tobytes())
            kept.append(summaries(x[None])[0].tobytes())
        return {"id": ids, "label": labels, "dim": list(map(len, vectors)), "ints": ints, "summary": kept}
    return map_texts(rows, work, "id long, label long, dim int, ints binary, summary binary")


def vectors_of(ids, labels, dims, ints, summary) -> dict[int, tuple[np.ndarray, Vectors]]:
    """Stored rows by dimension: which rows they are, and their vectors."""
    out, dims = {}, np.asarray(dims)
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        x = np.array([np.frombuffer(ints[k], f"<i{len(ints[k]) // dim}") for k in at], np.int64)
        s = np.array([np.frombuffer(summary[k], np.float32) for k in at]).reshape(len(at), -1, 2)
        out[dim] = at, Vectors([ids[k] for k in at], [labels[k] for k in at], x, s)
    return out


def best_rows(table: DataFrame, blocks: Shared, pairs: str, keys: int) -> DataFrame:
    """(key, dim, score, id): of each key of a block, the best rows of each task."""
    ddl = "dim int, key long, score long, id long"
    shape = arrow_schema(ddl)

    def run(batches):
        own = blocks.value
        best = {dim: Best(len(b.anchors) * keys, b.few) for dim, b in own.items()}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                cols = [c.to_pylist() for c in batch.slice(at, SLICE).columns]
                for dim, (_, rows) in vectors_of(*cols).items():
                    if dim in own:
                        getattr(own[dim], pairs)(rows, best[dim])
        for dim, b in best.items():
            k, s, i = b.rows()
            for at in range(0, len(k), 100_000):
                part = [x[at:at + 100_000] for x in (np.full(len(k), dim, np.int32), k, s, i)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in part], schema=shape)
    return table.mapInArrow(run, ddl)


def ranked(found: DataFrame, few: int) -> DataFrame:
    """The first ``few`` of each key, with their ``rank`` from 1."""
    order = Window.partitionBy("dim", "key").orderBy(F.desc("score"), "id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= few)


def mined(vectors: DataFrame, anchors: Column, label: Column, id_col: str = "vec_id", vector_col: str = "embedding",
          few: int = 5, ratio: tuple[int, int] = (80, 100), scale: int = 256, block: int = 4096) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows take part if id, label and vector are not null and the vector is not
    empty and holds no null or non-finite component; ``anchors`` (a condition)
    says which are anchors.  Components become floor(scale * x), a score is their
    integer inner product, defined between vectors of the same dimension only.
    An anchor's positives are the ``few`` best-scored other rows of its label,
    ties by smaller id; its negatives for a positive the ``few`` best-scored rows
    of other labels with num * positive <= den * negative <= den * positive
    (``ratio``).  Rows with the anchor's own id are no others of it; rows that
    repeat an id count once per score, anchors that are equal throughout once.
    Components or scores beyond the range of a long raise OverflowError.

    Anchors are dealt by hash into blocks of about ``block``; a block with its
    summaries, and ``few`` squared results an anchor, is what the driver and a
    task hold of it.
    """
    spark = vectors.sparkSession
    sound = F.forall(vectors[vector_col], lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), label.cast("long").alias("label"),
                          vectors[vector_col].alias("vector"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
                          F.coalesce(sound, F.lit(False)).alias("sound"))
    rows = rows.where("id is not null and label is not null and size(vector) > 0 and sound")
    table = cut_lineage(stored(rows.select("id", "label", "vector"), scale))
    chosen = cut_lineage(stored(rows.where("is_anchor").select("id", "label", "vector"), scale).distinct())
    blocks = max(1, math.ceil(chosen.count() / block))
    deal, out = F.pmod(F.xxhash64("id", "ints"), F.lit(blocks)), None
    for k in range(blocks):
        own = chosen.where(deal == k).orderBy("id", "label", "ints").toArrow()
        cols = [own[c].to_pylist() for c in ("id", "label", "dim", "ints", "summary")]
        known = {dim: v for dim, (_, v) in vectors_of(*cols).items()}
        sent = Shared(spark, {dim: Block(v, few) for dim, v in known.items()})
        positives = ranked(best_rows(table, sent, "positive_pairs", 1), few).toArrow().sort_by([("dim", "ascending"), (
            "key", "ascending"), ("rank", "ascending")])
        held = {dim: (np.full((len(v), few), _NONE), np.zeros((len(v), few), np.int64)) for dim, v in known.items()}
        for dim, key, score, i, rank in zip(*[positives[c].to_pylist() for c in ("dim", "key", "score", "id", "rank")]):
            held[dim][0][key, rank - 1], held[dim][1][key, rank - 1] = score, i
        sent = Shared(spark, {dim: Block(v, few, held[dim][0], ratio) for dim, v in known.items()})
        found = ranked(best_rows(table, sent, "negative_pairs", few), few)
        names = [(dim, int(a * few + r), int(v.ids[a]), int(held[dim][1][a, r]), int(held[dim][0][a, r]))
                 for dim, v in known.items() for a, r in zip(*np.nonzero(held[dim][0] > _NONE))]
        keys = spark.createDataFrame(names, "dim int, key long, anchor_id long, positive_id long, positive_score long")
        part = cut_lineage(found.join(F.broadcast(keys), ["dim", "key"]).select(       # few rows an anchor of the block
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")))
        out = part if out is None else out.union(part)
    return out
