"""Embedding near-dedup by cross-polytope hashing.

Unit vectors are rotated pseudo-randomly (three rounds of random signs and a
fast Hadamard transform); the nearest of the signed axes is the hash, a corner
of the cross-polytope.  Several rotations make a table's bucket, several tables
make misses rare, and each vector also probes the buckets of its second-best
corners.  Vectors that share a bucket are compared by exact cosine in double
precision, so nothing below the threshold is ever linked.

Equal vectors of a label are one class with a count.  A pair of classes may meet
in several buckets; it is counted in the first of them only, which the codes that
each row carries tell, so links are counted without listing them: a group of m
near copies gives rows in proportion to m.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import arrow_schema, connected, cut_lineage, factory, map_texts

#: Classes of one bucket that meet in one task: two chunks of about this size.
CHUNK = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform along the last axis, a power of two."""
    n, h = x.shape[-1], 1
    while h < n:
        y = x.reshape(*x.shape[:-1], n // (2 * h), 2, h)
        x = np.stack([y[..., 0, :] + y[..., 1, :], y[..., 0, :] - y[..., 1, :]], -2).reshape(x.shape)
        h *= 2
    return x / np.sqrt(n)


class CrossPolytope:
    """Codes of unit vectors: per table the home bucket, then the probed ones."""

    def __init__(self, dim: int, tables: int, hashes: int, probes: int, seed: int):
        self.size = 1 << max(1, (dim - 1).bit_length())
        self.tables, self.hashes, self.probes = tables, hashes, probes
        rng = np.random.Generator(np.random.PCG64(seed))
        self.signs = rng.choice([-1.0, 1.0], (tables, hashes, 3, self.size))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes) of int64 codes within a table."""
        wide = np.zeros((len(x), self.size))
        wide[:, :x.shape[1]] = x
        out = np.empty((len(x), self.tables, 1 + self.probes), np.int64)
        rows = np.arange(len(x))[:, None]
        corners = 2 * self.size
        for t in range(self.tables):
            best, loss, home = [], [], np.zeros(len(x), np.int64)
            for s in self.signs[t]:
                y = wide
                for d in s:
                    y = hadamard(y * d)
                order = np.abs(y).argpartition(-2, 1)[:, -2:]
                order = np.take_along_axis(order, np.take_along_axis(np.abs(y), order, 1).argsort(1)[:, ::-1], 1)
                value = np.take_along_axis(y, order, 1)
                corner = 2 * order + (value < 0)
                best.append(corner)
                loss.append(np.abs(value[:, 0]) - np.abs(value[:, 1]))
                home = home * corners + corner[:, 0]
            out[:, t, 0] = home
            # probes: the hashes whose runner-up is closest are swapped, singly and then together
            ranked = np.stack(loss, 1).argsort(1)
            weight = corners ** np.arange(self.hashes - 1, -1, -1)
            change = np.stack([(b[:, 1] - b[:, 0]) * w for b, w in zip(best, weight)], 1)
            change = np.take_along_axis(change, ranked, 1)
            sets = sorted(range(1, 1 << self.hashes), key=lambda m: (m.bit_count(), m))[:self.probes]
            for p, m in enumerate(sets):
                which = [h for h in range(self.hashes) if m >> h & 1]
                out[:, t, 1 + p] = home + change[:, which].sum(1)
        return out


def unit(vectors: np.ndarray) -> np.ndarray:
    a = vectors / np.abs(vectors).max(1, keepdims=True)     # no overflow of squares
    return a / np.sqrt((a * a).sum(1, keepdims=True))


def coded(found: DataFrame, tables: int, hashes: int, probes: int, seed: int) -> DataFrame:
    """Adds ``codes``: per table the home bucket, then the probed ones; vectors
    of other dimensions are hashed apart (``dim``)."""
    kind = found.schema["vector"].dataType.simpleString()

    @factory
    def make():
        hashers = {}

        def work(cls, grp, vector, copies):
            codes = [None] * len(vector)
            dims = {}
            for k, v in enumerate(vector):
                dims.setdefault(len(v), []).append(k)
            for dim, which in dims.items():
                if dim not in hashers:
                    hashers[dim] = CrossPolytope(dim, tables, hashes, probes, seed)
                got = hashers[dim](unit(np.array([vector[k] for k in which], np.float64)))
                for k, c in zip(which, got):
                    codes[k] = c.ravel()
            return {"cls": cls, "grp": grp, "dim": list(map(len, vector)), "vector": vector, "copies": copies,
                    "codes": codes}
        return work

    return map_texts(found.select("cls", "grp", "vector", "copies"), make,
                     f"cls long, grp long, dim int, vector {kind}, copies long, codes array<long>")


def meetings(table: DataFrame, tables: int, probes: int) -> DataFrame:
    """(cls, grp, dim, t, code, own, other): where classes have to be compared.

    A bucket needs a class at home and a second one.  The classes of a large
    bucket are dealt by hash into chunks; each pair of chunks is a group.
    """
    bucket = ["grp", "dim", "t", "code"]
    spots = (table.select("cls", "grp", "dim", F.posexplode("codes").alias("k", "code"))
             .withColumn("t", F.floor(F.col("k") / (1 + probes)).cast("int"))
             .withColumn("home", F.col("k") % (1 + probes) == 0)
             .groupBy("cls", *bucket).agg(F.max("home").alias("home")))
    sizes = (spots.groupBy(*bucket).agg(F.count("*").alias("size"), F.max("home").alias("any_home"))
             .where("size > 1 and any_home").drop("any_home"))
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("cls"), chunks).cast("int")
    return (spots.join(sizes, bucket).withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1)))
            .select("cls", *bucket, "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")))


def in_group(t: int, code: int, cls, own, vector, copies, codes, threshold: float):
    """(cls, links, root) of one group: links counted here, and the least class
    that these links reach within the group.

    A pair meets in every bucket that is one's home and that the other knows.  It
    counts in its first table only, and there in the home of the smaller class
    if the other knows that, else in the other's home.
    """
    x = unit(np.array(vector, np.float64))
    cls, own, copies, codes = np.array(cls), np.array(own), np.array(copies), np.array(codes)
    home = codes[:, t, 0] == code
    mixed = own.min() != own.max()
    ends = []
    for at in range(0, len(cls), 256):
        near = x[at:at + 256] @ x.T >= threshold - 1e-9
        near &= (home[at:at + 256, None] | home[None]) & (cls[at:at + 256, None] < cls[None])
        if mixed:                       # pairs within a chunk are compared in the chunk's own group
            near &= own[at:at + 256, None] != own[None]
        i, j = np.nonzero(near)
        ends.append((i + at, j))
    i, j = (np.concatenate(e) for e in zip(*ends))
    keep = np.ones(len(i), bool)
    for at in range(0, len(i), 100_000):
        p, q = i[at:at + 100_000], j[at:at + 100_000]
        ok = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
        for s in range(t):
            ok &= ~((codes[p, s, :1] == codes[q, s]).any(1) | (codes[q, s, :1] == codes[p, s]).any(1))
        known = (codes[p, t, :1] == codes[q, t]).any(1)
        keep[at:at + 100_000] = ok & (np.where(known, codes[p, t, 0], codes[q, t, 0]) == code)
    i, j = i[keep], j[keep]
    links = np.bincount(i, copies[j], len(cls)) + np.bincount(j, copies[i], len(cls))
    root = np.arange(len(cls))
    order = cls.argsort()
    rank = np.empty_like(order)
    rank[order] = np.arange(len(cls))
    i, j = rank[i], rank[j]
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return cls, links.astype(np.int64), cls[order][root[rank]]


def counted(table: DataFrame, tables: int, probes: int, threshold: float) -> DataFrame:
    """(cls, links, root) per class and group that it links in."""
    group = ["grp", "dim", "t", "code", "lo", "hi"]
    rows = (meetings(table, tables, probes).join(table.select("cls", "vector", "copies", "codes"), "cls")
            .select(*group, "cls", "own", "vector", "copies", "codes"))
    rows = rows.repartition(*group).sortWithinPartitions(*group, "cls")
    ddl = "cls long, links long, root long"
    shape = arrow_schema(ddl)

    def run(batches):
        held, now = [], None

        def done():
            if len(held) > 1:
                cls, own, vector, copies, codes = zip(*held)
                codes = np.array(codes).reshape(len(cls), tables, 1 + probes)
                out = in_group(now[2], now[3], cls, own, vector, copies, codes, threshold)
                some = out[1] > 0
                if some.any():
                    yield pa.RecordBatch.from_arrays([pa.array(c[some]) for c in out], schema=shape)
            held.clear()

        for b in batches:
            for at in range(0, b.num_rows, 1024):
                for row in zip(*[c.to_pylist() for c in b.slice(at, 1024).columns]):
                    if row[:6] != now:
                        yield from done()
                        now = row[:6]
                    held.append(row[6:])
        yield from done()

    return rows.mapInArrow(run, ddl)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = 0.98, tables: int = 8, hashes: int = 3, probes: int = 7,
                    seed: int = 20_231) -> DataFrame:
    """(id, n_links, component_id, kept) for every row, repeated rows included.

    Two vectors link if their labels are equal and not null, they have the same
    dimension and their cosine in double precision is at least ``threshold``.
    Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing.  ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable, ``kept`` says whether that is
    the row's own.  A null id keeps its row but is no component's id.

    Each of the ``tables`` misses a pair at cosine 0.98 in 64 dimensions with a
    probability of about 0.17 (measured); eight miss it with 6e-7.  The number
    of buckets per label is (2 * dim) ** hashes; raise ``hashes`` by one for
    each factor of a hundred beyond some 10 ** 8 vectors a label.
    """
    rows = vectors.select(vectors[id_col].alias("id"), vectors[label_col].alias("label"), vectors[vector_col].alias("vector"))
    fine = (F.col("label").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda c: (
        c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))) & F.exists("vector", lambda c: c != 0))
    rows = rows.withColumn("cls", F.when(F.coalesce(fine, F.lit(False)), F.xxhash64("label", "vector")))
    found = (rows.where("cls is not null").groupBy("cls")
             .agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("vector").alias("vector"),
                  F.first(F.xxhash64("label")).alias("grp")))
    table = cut_lineage(coded(found, tables, hashes, probes, seed))
    links = cut_lineage(counted(table, tables, probes, threshold))
    roots = connected(links.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    by_class = (rows.where("cls is not null").groupBy("cls").agg(F.min("id").alias("least"), F.count("*").alias("copies"))
                .join(roots.withColumnRenamed("id", "cls"), "cls", "left")
                .select("cls", "least", "copies", F.coalesce("root", "cls").alias("root")))
    by_root = by_class.groupBy("root").agg(F.min("least").alias("component_id"))
    totals = links.groupBy("cls").agg(F.sum("links").alias("links"))
    known = (by_class.join(by_root, "root").join(totals, "cls", "left")
             .select("cls", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    out = rows.select("id", "cls").join(known, "cls", "left")
    component = F.coalesce("component_id", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
