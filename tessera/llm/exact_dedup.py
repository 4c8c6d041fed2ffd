"""Exact dedup by progressive refinement.

Rows are told apart by ever dearer keys: the length of the text, then a hash of
its beginning as well, then a hash of all of it.  A row goes on to the next key
only if another row shares the present one, so texts whose length or beginning
is theirs alone are never hashed whole and never shuffled.

What a step hands to the next is which keys repeat: a bitmap over hashes of the
keys, of a stated size however many rows there are.  A bit may be set for a key
that does not repeat (its row is then hashed for nothing) but never the other
way round, and the last key decides alone; so the result does not depend on the
size of the bitmap.  No text leaves the task that reads it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Shared, cut_lineage, factory, join_unique, map_texts

#: ASCII white space; each run of it counts as one space.
WHITE = b" \t\n\x0b\x0c\r"
_SPACES = bytes.maketrans(WHITE, b" " * len(WHITE))
#: Bits that one row of a bitmap holds.
WORD = 32768


def normalised(text: str | None) -> bytes:
    """The text in UTF-8 with each run of ASCII white space replaced by one
    space; null as empty."""
    out = (text or "").encode().translate(_SPACES)
    while b"  " in out:         # halves the runs
        out = out.replace(b"  ", b" ")
    return out


def keys(body: bytes, prefix: int, bits: int) -> tuple[int, int]:
    """Bits of the text's length, and of its length and beginning."""
    size = len(body)
    by_length = xxhash.xxh64_intdigest(size.to_bytes(8, "little"))
    return by_length % bits, xxhash.xxh64_intdigest(body[:prefix], size) % bits


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """(word, bitmap): bits that two or more rows have; 4 kB a word."""
    spots = rows.groupBy(key).count().where("count > 1")
    return (spots.groupBy((F.col(key) / WORD).cast("long").alias("word"))
            .agg(F.bitmap_construct_agg((F.col(key) % WORD).cast("long")).alias("bitmap")))


def packed(bitmap: DataFrame, bits: int) -> np.ndarray:
    """The whole bitmap, bits / 8 bytes, on the driver."""
    out = np.zeros(bits // 8, np.uint8)
    for r in bitmap.collect():
        out[r.word * WORD // 8:][:WORD // 8] = np.frombuffer(r.bitmap, np.uint8)
    return out


def has_bit(bitmap: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return bitmap[spots >> 3] >> (spots & 7) & 1 > 0


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", all_digests: bool = False,
                     most_bits: int = 1 << 27, prefix: int = 512) -> DataFrame:
    """(id, keep_id, group_size, kept, digest), one row per input row.

    Texts are equal if they are after each run of ASCII white space has become
    one space; a null text counts as an empty one.  ``keep_id`` is the smallest id
    of the rows with an equal text, ``group_size`` their number, ``kept`` whether
    the row has that id: rows that repeat an id and its text are kept or dropped
    together.  A null id is never the smallest unless its group has no other;
    then its rows are kept.  ``digest``, the SHA-256 of the normalised text in
    UTF-8, is null where the text was found to be alone by its beginning, unless ``all_digests`` asks for it everywhere.  Texts of 256-bit digests
    are taken as equal.  A bitmap has eight bits a row, up to ``most_bits`` (16 MB);
    ``prefix`` is the number of bytes of a beginning.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    bits = min(most_bits, max(WORD, 1 << (8 * docs.count()).bit_length()))

    def spots(texts):
        found = [keys(normalised(t), prefix, bits) for t in texts]
        return {"by_length": [k[0] for k in found], "by_start": [k[1] for k in found]}

    table = cut_lineage(map_texts(rows.select("text"), spots, "by_length long, by_start long"))
    sized = Shared(spark, packed(repeated(table, "by_length"), bits))

    @factory
    def of_size():
        bitmap = sized.value
        return lambda by_length, by_start: {
            "by_start": np.array(by_start, np.int64)[has_bit(bitmap, np.array(by_length, np.int64))]}

    begun = Shared(spark, packed(repeated(map_texts(table, of_size, "by_start long"), "by_start"), bits))

    @factory
    def make():
        bitmap = begun.value

        def work(ids, texts):
            bodies = [normalised(t) for t in texts]
            again = has_bit(bitmap, np.array([keys(b, prefix, bits)[1] for b in bodies], np.int64)).tolist()
            return {"id": ids, "again": again, "digest": [
                hashlib.sha256(b).hexdigest() if a or all_digests else None for a, b in zip(again, bodies)]}
        return work

    kind = rows.schema["id"].dataType.simpleString()
    keyed = cut_lineage(map_texts(rows, make, f"id {kind}, again boolean, digest string"))
    alone = keyed.where("not again").select("id", "digest", F.col("id").alias("keep_id"), F.lit(1).alias("group_size"))
    some = keyed.where("again").select("id", "digest")
    groups = some.groupBy("digest").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    return alone.union(join_unique(some, groups, "digest", "group_size")).select(
        "id", "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "digest")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; rows with a
    null id stay, as nothing can name them."""
    found = exact_duplicates(docs, id_col, text_col, **how)
    gone = cut_lineage(found.where("not kept and id is not null").select(F.col("id").alias("__gone")).distinct())
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
