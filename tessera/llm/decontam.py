"""Benchmark decontamination by size-partitioned MinHash containment search.

A short test item inside a long document has a tiny Jaccard similarity with
it, so signatures of both sides never agree.  Containment is asymmetric
instead: an item is sketched by its least shingle hashes (a bottom-s MinHash
sketch), and a document is a candidate if it holds any of them.  Items are
partitioned by size, and each partition has its own sketch size s: with q
shingles and a threshold t, a document that holds at least ceil(t*q) of them
misses at most q - ceil(t*q), so s = 1 + the largest such miss in the
partition makes the search exact, not likely.  Candidates are verified by exact
shingle containment against the whole document.

An item of fewer words than a shingle is one shingle as wide as itself, and
documents are read with shingles of that width too.

Items travel to the tasks in blocks of a bounded number of shingles; documents
are never shuffled and every text is read whole, once for each block.
"""

from __future__ import annotations

import math
import re
from typing import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Shared, ShingleHasher, factory, filter_rows, map_texts

WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return WORD.findall(text.lower())


def least(q: int, threshold: float) -> int:
    """Smallest number of shared shingles that reaches the threshold."""
    return max(1, math.ceil(threshold * q - 1e-9))


class Sketches:
    """Sketches of items of one shingle width, joined over their size partitions."""

    def __init__(self, items: list[tuple[int, np.ndarray]], threshold: float):
        self.threshold, self.items = threshold, items
        parts: dict[int, list[int]] = {}
        for k, (_, s) in enumerate(items):
            if len(s):
                parts.setdefault(len(s).bit_length(), []).append(k)
        keys, owners = [], []
        for part in parts.values():
            size = 1 + max(len(items[k][1]) - least(len(items[k][1]), threshold) for k in part)
            for k in part:
                keys.append(items[k][1][:size])     # sorted: the least hashes
                owners.append(np.full(len(keys[-1]), k))
        keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
        owners = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = keys.argsort(kind="stable")
        self.keys, self.owners = keys[order], owners[order]
        self.maybe = np.zeros(1 << 20, bool)        # by the low bits: most shingles stop here
        self.maybe[(self.keys & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def candidates(self, hashes: np.ndarray) -> set[int]:
        hashes = np.unique(hashes[self.maybe[(hashes & np.uint64(0xFFFFF)).astype(np.int64)]])
        a, b = self.keys.searchsorted(hashes, "left"), self.keys.searchsorted(hashes, "right")
        return {k for x, y in zip(a[a < b].tolist(), b[a < b].tolist()) for k in self.owners[x:y].tolist()}

    def verified(self, hashes: np.ndarray):
        """(item id, its shingles, how many of them the document holds)."""
        found = self.candidates(hashes)
        if found:
            held = np.unique(hashes)
            for k in sorted(found):
                item, own = self.items[k]
                at = held.searchsorted(own)
                n = int((held.take(at, mode="clip") == own).sum())
                if n >= least(len(own), self.threshold):
                    yield item, len(own), n


class Search:
    """Items of one block by their shingle width."""

    def __init__(self, items: list[tuple[int, int, np.ndarray]], threshold: float):
        self.by_width = {w: Sketches([(i, s) for i, width, s in items if width == w], threshold)
                         for w in sorted({width for _, width, _ in items})}

    def reader(self):
        """Function from a text to its (item id, shingles of it, how many are held)."""
        readers = [(w, ShingleHasher(w, words), sketches) for w, sketches in self.by_width.items()]

        def found(text):
            for w, hasher, sketches in readers:
                yield from sketches.verified(hasher(text))
        return found


def item_shingles(items: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """(item_id, width, shingles): sorted distinct shingle hashes of each item,
    of ``width`` words or of all that it has."""
    @factory
    def make():
        hashers = {w: ShingleHasher(w, words) for w in range(1, width + 1)}

        def work(key, text):
            out = {"item_id": key, "width": [], "shingles": []}
            for t in text:
                w = min(width, max(1, len(words(t or ""))))
                out["width"].append(w)
                out["shingles"].append(np.unique(hashers[w](t)).view(np.int64))
            return out
        return work

    kind = items.schema[item_col].dataType.simpleString()
    return map_texts(items.select(items[item_col].alias("item_id"), items[text_col].alias("text")), make,
                     f"item_id {kind}, width int, shingles array<long>")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", width: int = 5,
                 threshold: float = 0.8, block_shingles: int = 2_000_000) -> DataFrame:
    """(doc_id, item_id, item_shingles, shared): every document and item where
    the document holds at least ``threshold`` of the item's distinct shingles.

    Words are runs of letters and digits in lower case, shingles ``width`` words;
    an item with fewer words has one shingle of all of them, which a document
    holds if these words stand in it one after another.  Items or documents without
    words (null and empty ones) are in no pair.  Rows that repeat, in either
    table, give a row each.  Items are dealt by hash into blocks of about
    ``block_shingles`` hashes (16 MB), the most that the driver and a task hold
    besides a single item's text.
    """
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    item_kind = items.schema[item_col].dataType.simpleString()
    out = None
    for shared in searches(items, item_col, item_text_col, width, threshold, block_shingles):
        @factory
        def make(shared=shared):
            found = shared.value.reader()

            def work(ids, texts):
                out = {"doc_id": [], "item_id": [], "item_shingles": [], "shared": []}
                for i, t in zip(ids, texts):
                    for row in found(t):
                        for column, v in zip(out.values(), (i, *row)):
                            column.append(v)
                return out
            return work

        found = map_texts(rows, make, f"doc_id {kind}, item_id {item_kind}, item_shingles long, shared long")
        out = found if out is None else out.union(found)
    return out


def searches(items: DataFrame, item_col: str, text_col: str, width: int, threshold: float,
                block_shingles: int) -> Iterator[Shared]:
    """The search of one block of items after another, sent to the tasks."""
    sets = item_shingles(items, item_col, text_col, width).where(F.size("shingles") > 0)
    total = sets.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(total / block_shingles))
    for k in range(blocks):
        own = [(r[0], r[1], np.sort(np.array(r[2], np.int64).view(np.uint64)))
               for r in sets.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == k).collect()]
        yield Shared(items.sparkSession, Search(own, threshold))


def without_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                         item_text_col: str = "text", width: int = 5, threshold: float = 0.8,
                         block_shingles: int = 2_000_000) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns; the
    definitions are those of ``contaminated``."""
    for shared in searches(items, item_col, item_text_col, width, threshold, block_shingles):
        @factory
        def make(shared=shared):
            found = shared.value.reader()
            return lambda texts: [not any(True for _ in found(t)) for t in texts]

        docs = filter_rows(docs, text_col, make)
    return docs
