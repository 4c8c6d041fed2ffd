"""N-gram Jaccard self-join by parity sketches.

A document is its set of word shingles, 64-bit hashes.  XOR-ing hashes into the
bits of a sketch cancels what two documents share, so the Hamming distance of
two sketches never exceeds the symmetric difference of the sets, and a Jaccard
threshold bounds that difference by a share of the sizes.

1. Sizes are cut into overlapping bands; every pair that can link meets in one.
   A band allows a difference of d, so its sketch is cut into more than d blocks:
   a linked pair agrees on a block that is not empty (pigeonhole).
2. Blocks are the join keys.  They travel in packed arrays, many to a row, and
   only keys that two different sets share leave the tasks that meet them.
3. A set is first held against the one set that heads most of its keys, and where
   components still differ against a few sets of each key; the links found are
   closed into components each time.  Then the pairs of a key whose components still differ are compared,
   large keys in blocks.  Comparing means
   the Hamming bound of the sets' bit sketches, then the exact sets.

So a group of any size costs a number of comparisons in proportion to it as long
as its members link, and no pairs are listed that a component already joins.
Equal sets are one class throughout (64-bit set hashes: of n different sets two
share one with probability n * n / 2**65).
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (ShingleHasher, arrow_schema, ascii_words, connected, cut_lineage, factory, map_texts,
                                mix64, small_batches, tidy)

_U = np.uint64
#: Join keys that a task of the key join holds at most, on average.
KEYS_PER_TASK = 1_000_000
#: Join keys that a task packs at once.
PIECE = 250_000
#: Classes of one key that a task sends to be met; of more, the key is known to be shared.
SPREAD = 64
#: Sets of one key that are compared within one task at most.
CHUNK = 2048
#: Keys of at most so many sets have their pairs listed, without the sketches.
SMALL = 16


class Threshold:
    """Jaccard similarity of at least num / den, in integers."""

    def __init__(self, num: int, den: int, ratio: float = 1.5):
        self.num, self.den, self.ratio = num, den, max(ratio, den / num)

    def links(self, shared: int, a: int, b: int) -> bool:
        return self.den * shared >= self.num * (a + b - shared)

    def difference(self, total):
        """Largest symmetric difference of two linked sets with ``total`` elements together."""
        return total * (self.den - self.num) // (self.den + self.num)

    def bands(self, n: int) -> list[tuple[int, int, int]]:
        """(band, blocks, spare) where a set of n elements takes part: the band
        of its size, and the one below as the larger partner."""
        j = int(math.floor(math.log(n) / math.log(self.ratio) + 1e-9))
        while self.ratio ** (j + 1) <= n:
            j += 1
        while self.ratio ** j > n:
            j -= 1
        out = [(j, *self._blocks(j))]
        if j > 0 and n * self.num <= self.ratio ** j * self.den:
            out.append((j - 1, *self._blocks(j - 1)))
        return [b for b in out if b[1]]

    def keys_per_element(self) -> float:
        """No set of 20 elements or more has more join keys than this for each."""
        sizes = np.unique(np.geomspace(20, 1e6, 200).astype(int)).tolist()
        return max(sum(k for _, k, _ in self.bands(n)) / n for n in sizes)

    def _blocks(self, j: int) -> tuple[int, int]:
        """A linked pair whose smaller set is of band j agrees on at least
        spare + 1 of the blocks; no blocks where only equal sets link."""
        smaller = math.ceil(self.ratio ** (j + 1)) - 1
        d = smaller * (self.den - self.num) // self.num
        if d == 0:
            return 0, 0
        spare = 1
        for _ in range(3):      # about the number of blocks that stay empty
            k = d + 1 + spare
            spare = 1 + math.ceil(k * math.exp(-self.ratio ** j / k))
            spare = min(spare, max(1, d // 2))
        return d + 1 + spare, spare


def block_keys(hashes: np.ndarray, threshold: Threshold, layouts: int = 6) -> np.ndarray:
    """Join keys of a set: its blocks in every band where it takes part.

    Empty blocks say nothing and are left out, which is safe while there are no
    more of them than spare blocks.  A set with more also takes the next layout
    (other blocks for the same elements): a pair that agrees on empty blocks
    only has too many in both its sets, and so meets in the next one.  After the
    last layout the empty blocks are keys as well.
    """
    out = []
    for band, k, spare in threshold.bands(len(hashes)):
        for s in range(layouts):
            tag = _U((band << 40) | (s << 32))
            h = hashes * _U(0xD6E8FEB86659FD93 + 2 * s)     # the hashes are mixed already
            block = (((h >> _U(40)) * _U(k)) >> _U(24)).astype(np.int64)
            parity = np.zeros(k, _U)
            np.bitwise_xor.at(parity, block, h ^ (h >> _U(31)))
            full = np.bincount(block, minlength=k) > 0
            enough = k - int(full.sum()) <= spare
            which = np.flatnonzero(full) if enough or s < layouts - 1 else np.arange(k)
            out.append(mix64(parity[which] + mix64(tag + which.astype(_U))))
            if enough:
                break
    return np.concatenate(out) if out else np.empty(0, _U)


def bit_sketch(hashes: np.ndarray, threshold: Threshold) -> bytes:
    """Parity of the set's hashes in a power of two of bits, 32 times what two
    linked sets may differ by, so that few differences cancel; halves fold onto
    each other by XOR."""
    need = 32 * len(hashes) * (threshold.den - threshold.num) // threshold.num
    bits = max(64, 1 << max(0, need - 1).bit_length())
    odd = np.bincount((mix64(hashes) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def set_class(hashes: np.ndarray) -> int:
    """64-bit hash of a set."""
    spread = hashes * _U(0x9E3779B97F4A7C15)
    both = np.array([np.bitwise_xor.reduce(spread ^ (spread >> _U(29))), (spread >> _U(7)).sum(dtype=_U), len(hashes)], _U)
    both = mix64(both)
    return int(mix64(both[:1] + (both[1:2] ^ (both[2:] << _U(1)))).view(np.int64)[0])


def _hasher(width: int, words: Callable):
    hasher = ShingleHasher(width, words)
    return lambda text: np.unique(hasher(text))


def members(rows: DataFrame, width: int, words: Callable) -> DataFrame:
    """(id, n, cls): size and class of each document's set; class null if empty."""
    @factory
    def make():
        sets = _hasher(width, words)

        def work(ids, texts):
            n, cls = [], []
            for t in texts:
                s = sets(t)
                n.append(len(s))
                cls.append(set_class(s) if len(s) else None)
            return {"id": ids, "n": n, "cls": cls}
        return work

    kind = rows.schema["id"].dataType.simpleString()
    return map_texts(rows, make, f"id {kind}, n long, cls long")


class Often:
    """Join keys that a task has met with more than ``SPREAD`` classes.

    Keys count that come ``SPREAD`` / 8 times in one piece, so a task has few; of
    the rest it sends fewer than that many classes a piece."""

    def __init__(self):
        self.seen: dict[int, int] = {}

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Of sorted keys, which belong to one that is met often, its first
        entry left out: that one still says that the key exists."""
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        out = np.zeros(len(keys), bool)
        for k in np.flatnonzero(sizes >= SPREAD // 8).tolist():
            at, n, key = int(starts[k]), int(sizes[k]), int(keys[starts[k]])
            self.seen[key] = self.seen.get(key, 0) + n
            if self.seen[key] > SPREAD:
                out[at + 1:at + n] = True
        if len(self.seen) > 200_000:
            self.seen = {k: n for k, n in self.seen.items() if n > SPREAD}
        return out


def shared_keys(rows: DataFrame, width: int, words: Callable, threshold: Threshold, total: int) -> DataFrame:
    """(key, cls): keys that at least two different classes have, and these.

    A map task sends, for each receiving task, one row of packed keys and
    classes per piece; a class that repeats within a map task is sent once.  The
    number of receivers grows with the ``total`` number of elements.  What is known
    to be shared where it is made, most classes of a hot key, is dealt out evenly
    and only handed on: a receiver never holds a hot key whole.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                math.ceil(total * threshold.keys_per_element() / KEYS_PER_TASK))
    fine = 4 * parts
    ddl = "part int, keys binary, classes binary"
    shape = arrow_schema(ddl)

    def packed(k, c, part, first):
        """Rows of a part each, numbered from ``first``."""
        order = part.argsort(kind="stable")
        k, c = k[order], c[order]
        ends = np.bincount(part, minlength=fine).cumsum()
        at_part = np.flatnonzero(np.diff(ends, prepend=0))
        cuts = [(int(ends[p - 1]) if p else 0, int(ends[p])) for p in at_part]
        return pa.RecordBatch.from_arrays(
            [pa.array((at_part + first).astype(np.int32)), pa.array([k[x:y].tobytes() for x, y in cuts], pa.binary()),
             pa.array([c[x:y].tobytes() for x, y in cuts], pa.binary())], schema=shape)

    def send(batches):
        sets, seen, often = _hasher(width, words), set(), Often()
        keys, classes, size = [], [], 0

        def piece():
            k, c = np.concatenate(keys), np.concatenate(classes)
            order = k.argsort(kind="stable")
            k, c = k[order], c[order]
            known = often(k)
            if known.any():
                yield packed(k[known], c[known], (mix64(k[known] ^ c[known].view(_U)) % _U(fine)).astype(np.int64), fine)
                k, c = k[~known], c[~known]
            yield packed(k, c, (mix64(k) % _U(fine)).astype(np.int64), 0)

        for b in batches:
            for at in range(0, b.num_rows, 64):
                for t in b.column(0).slice(at, 64).to_pylist():
                    s = sets(t)
                    cls = set_class(s) if len(s) else None
                    if cls is not None and cls not in seen:
                        if len(seen) > 500_000:
                            seen.clear()
                        seen.add(cls)
                        keys.append(block_keys(s, threshold))
                        classes.append(np.full(len(keys[-1]), cls, np.int64))
                        size += len(keys[-1])
                if size > PIECE:
                    yield from piece()
                    keys, classes, size = [], [], 0
        if size:
            yield from piece()
        del keys, classes
        seen.clear()
        tidy()

    out_ddl = "key long, cls long"
    out_shape = arrow_schema(out_ddl)

    def rows_of(k, c):
        for x in range(0, len(k), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(k[x:x + 100_000]), pa.array(c[x:x + 100_000])], schema=out_shape)

    def meet(batches):
        held = []
        for b in batches:
            for part, k, c in zip(*[x.to_pylist() for x in b.columns]):
                k, c = np.frombuffer(k, np.int64), np.frombuffer(c, np.int64)
                if part >= fine:
                    yield from rows_of(k, c)
                else:
                    held.append((k, c))
        if not held:
            return
        k, c = map(np.concatenate, zip(*held))
        held.clear()
        order = k.argsort(kind="stable")
        k, c = k[order], c[order]
        same = k[1:] == k[:-1]
        more = np.append(False, same) | np.append(same, False)
        k, c = k[more], c[more]
        order = np.lexsort((c, k))
        k, c = k[order], c[order]
        new = np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1])) if len(k) else np.empty(0, bool)
        k, c = k[new], c[new]
        same = k[1:] == k[:-1]
        more = np.append(False, same) | np.append(same, False) if len(k) else new[new]
        k, c = k[more], c[more]
        del same, more, new, order
        yield from rows_of(k, c)
        del k, c
        tidy()

    small_batches(rows)
    sent = rows.select("text").mapInArrow(send, ddl)
    return sent.repartition(parts, "part").mapInArrow(meet, out_ddl)


def candidates_of(rows: DataFrame, need: DataFrame, width: int, words: Callable, threshold: Threshold) -> DataFrame:
    """(cls, n, sketch, text) of the classes in ``need`` (id, cls)."""
    @factory
    def make():
        sets = _hasher(width, words)

        def work(cls, texts):
            out = {"cls": [], "n": [], "sketch": [], "text": []}
            for c, t in zip(cls, texts):
                s = sets(t)
                if len(s) and set_class(s) == c:        # an id may stand for other texts as well
                    for column, v in zip(out.values(), (c, len(s), bit_sketch(s, threshold), t)):
                        column.append(v)
            return out
        return work

    return map_texts(rows.join(need, "id").select("cls", "text"), make, "cls long, n long, sketch binary, text string")


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the shortest."""
    size = min(map(len, sketches))
    out = np.empty((len(sketches), size // 8), _U)
    for k, s in enumerate(sketches):
        words = np.frombuffer(s, _U)
        while words.nbytes > size:
            half = len(words) // 2
            words = words[:half] ^ words[half:]
        out[k] = words
    return out


def within(a: bytes, b: bytes, na: int, nb: int, threshold: Threshold) -> bool:
    """Whether the sketches allow a link."""
    x, y = folded([a, b])
    return int(np.bitwise_count(x ^ y).sum()) <= threshold.difference(na + nb)


def sketch_filter(pairs: DataFrame, table: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs (a, b) whose sizes and sketches allow a link."""
    side = table.select("cls", "n", "sketch")
    rows = (pairs.join(side.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
            .join(side.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
            .where(f"least(na, nb) * {threshold.den} >= greatest(na, nb) * {threshold.num}")
            .select("a", "b", "na", "nb", "sa", "sb"))

    def work(a, b, na, nb, sa, sb):
        keep = [within(*x, threshold) for x in zip(sa, sb, na, nb)]
        return {"a": [x for x, k in zip(a, keep) if k], "b": [x for x, k in zip(b, keep) if k]}

    return map_texts(rows, work, "a long, b long")


def verified(pairs: DataFrame, table: DataFrame, width: int, words: Callable, threshold: Threshold) -> DataFrame:
    """Pairs (a, b) that link, by their exact shingle sets."""
    side = table.select("cls", "text")
    rows = (pairs.join(side.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a")
            .join(side.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b")
            .select("a", "b", "ta", "tb"))

    @factory
    def make():
        sets, held = _hasher(width, words), {}

        def of(cls, text):
            s = held.get(cls)
            if s is None:
                if len(held) > 256:
                    held.clear()
                s = held[cls] = sets(text)
            return s

        def work(a, b, ta, tb):
            out = {"a": [], "b": []}
            for i, j, x, y in zip(a, b, ta, tb):
                p, q = of(i, x), of(j, y)
                if threshold.links(len(np.intersect1d(p, q, assume_unique=True)), len(p), len(q)):
                    out["a"].append(i)
                    out["b"].append(j)
            return out
        return work

    return map_texts(rows, make, "a long, b long")


def with_label(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Adds the component found so far, a class of its own by default."""
    if labels is None:
        return rows.withColumn("label", F.col("cls"))
    return (rows.join(labels.select(F.col("id").alias("cls"), "root"), "cls", "left")
            .select(*rows.columns, F.coalesce("root", "cls").alias("label")))


def unsettled(keys: DataFrame) -> DataFrame:
    """Rows (key, cls, label) of keys whose classes lie in different components."""
    found = keys.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("key")
    return keys.join(found, "key")


def main_heads(keys: DataFrame) -> DataFrame:
    """Pairs (cls, head): of the first classes, in a random order, of a class's keys
    the one that most of these have."""
    first = keys.groupBy("key").agg(F.min(F.struct(F.xxhash64("cls", F.lit(0)).alias("h"), "cls")).alias("first"))
    pairs = keys.join(first.select("key", F.col("first.cls").alias("head")), "key").where("cls <> head")
    return (pairs.groupBy("cls", "head").agg(F.count("*").alias("n"))
            .groupBy("cls").agg(F.max_by("head", F.struct("n", "head")).alias("head")))


def more_heads(keys: DataFrame, heads: int) -> DataFrame:
    """Pairs (cls, head) of a key and of different components; heads are the key's first
    classes in further random orders, all but one of ``heads``."""
    first = [F.struct(F.min_by("cls", F.xxhash64("cls", F.lit(k))).alias("cls"),
                      F.min_by("label", F.xxhash64("cls", F.lit(k))).alias("label")) for k in range(1, heads)]
    found = keys.groupBy("key").agg(F.array(*first).cast("array<struct<cls: bigint, label: bigint>>").alias("heads"))
    return (keys.join(found, "key").select("cls", "label", F.explode("heads").alias("head")).where("label <> head.label")
            .select("cls", F.col("head.cls").alias("head")))


def small_key_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of one key, of different components, for keys of at most
    ``SMALL`` rows: each row meets the next ones of its key, whole batches at a
    time; pairs that share several keys are merged."""
    shape = arrow_schema("a long, b long")

    def pairs(key, cls, label):
        left, right = [], []
        for d in range(1, SMALL):
            same = key[d:] == key[:-d]
            if not same.any():
                break
            ok = same & (label[d:] != label[:-d])
            left.append(cls[:-d][ok])
            right.append(cls[d:][ok])
        if not left:
            return
        x, y = np.concatenate(left), np.concatenate(right)
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        new = np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])) if len(x) else np.empty(0, bool)
        if len(x):
            yield pa.RecordBatch.from_arrays([pa.array(x[new]), pa.array(y[new])], schema=shape)

    def run(batches):
        held = [np.empty(0, np.int64)] * 3
        for batch in batches:
            held = [np.concatenate((h, c.to_numpy(zero_copy_only=False))) for h, c in zip(held, batch.columns)]
            if len(held[0]) > 200_000:
                cut = int(np.flatnonzero(held[0] != held[0][-1])[-1]) + 1 if (held[0] != held[0][-1]).any() else 0
                yield from pairs(*[h[:cut] for h in held])
                held = [h[cut:] for h in held]
        yield from pairs(*held)

    return (rows.select("key", "cls", "label").repartition("key").sortWithinPartitions("key", "cls")
            .mapInArrow(run, "a long, b long").distinct())


def remaining_pairs(rows: DataFrame, table: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs (a, b) of one key, of different components, whose sketches allow a link.

    The rows of a key beyond ``SMALL`` are dealt by hash into chunks of about
    ``CHUNK``; each pair of chunks is a group of its own, so no task gets a large
    key whole, and only pairs that the sketches allow leave it.
    """
    small = sketch_filter(small_key_pairs(rows.where(F.col("size") <= SMALL)), table, threshold)
    rows = rows.where(F.col("size") > SMALL)
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("cls"), chunks).cast("int")
    dealt = (rows.withColumn("chunks", chunks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("cls", "label", "own", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("grp")))
    dealt = (dealt.join(table.select("cls", "n", "sketch"), "cls").select("grp", "own", "cls", "label", "n", "sketch")
             .repartition("grp").sortWithinPartitions("grp", "own", "cls"))
    shape = arrow_schema("a long, b long")

    def compare(cls, label, n, own, sketch):
        words = folded(sketch)
        cls, label, n, own = map(np.array, (cls, label, n, own))
        mixed = own.min() != own.max()
        for x in range(0, len(cls), 256):
            near = np.zeros((min(256, len(cls) - x), len(cls)), np.int64)
            for w in range(words.shape[1]):
                near += np.bitwise_count(words[x:x + 256, None, w] ^ words[None, :, w])
            total = n[x:x + 256, None] + n[None]
            ok = (near <= threshold.difference(total)) & (label[x:x + 256, None] != label[None])
            if mixed:       # pairs within a chunk are compared in the chunk's own group
                ok &= own[x:x + 256, None] != own[None]
            i, j = np.nonzero(ok)
            i += x
            i, j = i[cls[i] < cls[j]], j[cls[i] < cls[j]]
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(cls[i]), pa.array(cls[j])], schema=shape)

    def run(batches):
        held: list[list] = [[] for _ in range(5)]
        now = None

        def done():
            if len(held[0]) > 1:
                yield from compare(*held)
            for h in held:
                h.clear()

        for b in batches:
            grp, own, cls, label, n, sketch = [c.to_pylist() for c in b.columns]
            for row in zip(grp, cls, label, n, own, sketch):
                if row[0] != now:
                    yield from done()
                    now = row[0]
                for h, v in zip(held, row[1:]):
                    h.append(v)
        yield from done()

    return small.union(dealt.mapInArrow(run, "a long, b long")).distinct()


def classes_and_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, num: int = 90,
                      den: int = 100, words: Callable = ascii_words, heads: int = 6):
    """``members`` (id, n, cls), one row per input row, and ``links`` (a, b)
    between classes, enough of them to join every class to all it is linked
    with, directly or by way of others."""
    threshold = Threshold(num, den)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    belongs = cut_lineage(members(rows, width, words))
    total = belongs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    keys = cut_lineage(shared_keys(rows, width, words, threshold, total))
    first = belongs.where("cls is not null").groupBy("cls").agg(F.min("id").alias("id"))
    need = first.join(keys.select("cls").distinct(), "cls")
    table = cut_lineage(candidates_of(rows, need, width, words, threshold))
    # a set against the one head that most of its keys have, so that a large group is not
    # compared with all the heads of its keys; then, where that left a key's sets apart,
    # each of the key's heads: enough to join most that belong together
    def joined(near):
        near = near.select(F.least("cls", "head").alias("a"), F.greatest("cls", "head").alias("b")).distinct()
        near = cut_lineage(sketch_filter(near, table, threshold))    # so that no task has two Python workers
        return cut_lineage(verified(near, table, width, words, threshold))

    links = joined(main_heads(keys if heads else keys.limit(0)))
    # keys that are settled now stay so
    keys = cut_lineage(unsettled(with_label(keys, connected(links))))
    links = links.union(joined(more_heads(keys, heads)))
    labels = connected(links)
    # then every pair of a key that is still apart
    rest = unsettled(with_label(keys.select("key", "cls"), labels))
    rest = rest.join(rest.groupBy("key").agg(F.count("*").alias("size")), "key")
    rest = remaining_pairs(rest, table, threshold)
    more = cut_lineage(verified(rest, table, width, words, threshold))
    labels = connected(more.union(labels.select(F.col("id").alias("a"), F.col("root").alias("b"))))
    return belongs, links.union(more), labels


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, n_shingles, component_id) for every row, repeated rows included.

    Documents link when their sets have a Jaccard similarity of at least num /
    den (90 / 100 over shingles of 3 words unless stated otherwise);
    ``component_id`` is the smallest id that is reachable by links, its own
    included.  A text with fewer words than a shingle is one shingle of all of
    them; a null, empty or blank text has the empty set, links with nothing and
    is its own component.  A null id counts for no component but keeps its row.
    """
    belongs, _, labels = classes_and_links(docs, id_col, text_col, **how)
    least = with_label(belongs.where("cls is not null").groupBy("cls").agg(F.min("id").alias("least")), labels)
    roots = least.groupBy("label").agg(F.min("least").alias("component_id"))
    by_class = least.join(roots, "label").select("cls", "component_id")
    return (belongs.join(by_class, "cls", "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the least of their component, with all
    their columns; a null id cannot be named, so its row stays."""
    found = components(docs, id_col, text_col, **how)
    gone = cut_lineage(found.where("id <> component_id").select(F.col("id").alias("__gone")).distinct())
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
