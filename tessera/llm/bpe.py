"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The symbols of a pre-token form a linked list.  Every adjacent pair that the
vocabulary can merge waits in the bucket of its rank; a bucket holds the list
positions, leftmost first.  Three levels of 64-bit words mark the buckets that
are not empty, so the lowest rank is three find-first-set steps away and a
pre-token of n bytes takes O(n log n), also when it is very long.  An entry
whose pair has meanwhile changed is stale and skipped.

The vocabulary (rank file) is read once on the driver and broadcast; its size
is that of the file, about a megabyte, whatever the corpus.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import Shared, factory, map_texts

#: Splits texts before the merges (fixed by the vocabulary).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|"
           r"\s+(?!\S)|\s+")


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks by token bytes, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class RankQueue:
    """Merges one pre-token after another; empty between them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        top = max(ranks.values()) + 1
        self.low = [0] * ((top >> 6) + 1)
        self.mid = [0] * ((top >> 12) + 1)
        self.high = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, pos: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, pos)
            return
        self.buckets[rank] = [pos]
        i, j = rank >> 6, rank >> 12
        self.low[i] |= 1 << (rank & 63)
        self.mid[j] |= 1 << (i & 63)
        self.high |= 1 << j

    def pop(self) -> tuple[int, int]:
        """Lowest rank and its leftmost position."""
        j = (self.high & -self.high).bit_length() - 1
        w = self.mid[j]
        i = (j << 6) | ((w & -w).bit_length() - 1)
        w = self.low[i]
        rank = (i << 6) | ((w & -w).bit_length() - 1)
        bucket = self.buckets[rank]
        pos = heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            self.low[i] ^= 1 << (rank & 63)
            if not self.low[i]:
                self.mid[j] ^= 1 << (i & 63)
                if not self.mid[j]:
                    self.high ^= 1 << j
        return rank, pos

    def encode(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of a pre-token."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return (whole,)
        n = len(piece)
        after = list(range(1, n + 2))       # start of the next symbol; n is the end
        before = list(range(-1, n))
        waits = [-1] * (n + 1)              # rank of the pair that begins here
        push = self.push
        for i in range(n - 1):
            r = ranks.get(piece[i:i + 2])
            if r is not None:
                waits[i] = r
                push(r, i)
        while self.high:
            rank, i = self.pop()
            if waits[i] != rank:
                continue                    # stale: the pair has changed
            gone = after[i]
            k = after[gone]
            waits[gone] = -1
            after[i] = k
            if k < n:
                before[k] = i
                r = ranks.get(piece[i:after[k]])
            else:
                r = None
            if r is None:
                waits[i] = -1
            else:
                waits[i] = r
                push(r, i)
            p = before[i]
            if p >= 0:
                r = ranks.get(piece[p:k])
                if r is None:
                    waits[p] = -1
                else:
                    waits[p] = r
                    push(r, p)
        out, i = [], 0
        while i < n:
            k = after[i]
            out.append(ranks[piece[i:k]])
            i = k
        return tuple(out)


class BatchQueue(RankQueue):
    """The same queue over many short pre-tokens at once, laid end to end.

    A bucket holds positions of all of them (numpy arrays).  Each step pops the
    lowest rank and merges the leftmost waiting position of every pre-token; a
    pre-token's other positions go back into the bucket, as its merge may have
    made a pair of lower rank.  Each pre-token so sees its own order of merges.
    """

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__(ranks)
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for word, r in ranks.items():
            for cut in range(1, len(word)):
                left, right = ranks.get(word[:cut]), ranks.get(word[cut:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = r
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()] + [-1], np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = self.keys.searchsorted(key)
        at[self.keys.take(at, mode="clip") != key] = -1
        return self.values[at]

    def _put(self, ranks: np.ndarray, pos: np.ndarray) -> None:
        """Positions into the buckets of their ranks."""
        order = ranks.argsort(kind="stable")
        ranks, pos = ranks[order], pos[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        buckets, low, mid = self.buckets, self.low, self.mid
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:]):
            bucket = buckets.get(rank)
            if bucket is None:
                buckets[rank] = [pos[a:b]]
                low[rank >> 6] |= 1 << (rank & 63)
                mid[rank >> 12] |= 1 << ((rank >> 6) & 63)
                self.high |= 1 << (rank >> 12)
            else:
                bucket.append(pos[a:b])

    def _take(self) -> tuple[int, np.ndarray]:
        """Lowest rank and all positions of its bucket."""
        j = (self.high & -self.high).bit_length() - 1
        w = self.mid[j]
        i = (j << 6) | ((w & -w).bit_length() - 1)
        w = self.low[i]
        rank = (i << 6) | ((w & -w).bit_length() - 1)
        self.low[i] = w & (w - 1)
        if not self.low[i]:
            self.mid[j] ^= 1 << (i & 63)
            if not self.mid[j]:
                self.high ^= 1 << j
        parts = self.buckets.pop(rank)
        return rank, parts[0] if len(parts) == 1 else np.concatenate(parts)

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids of each (non-empty) pre-token, packed."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        n = int(sizes.sum())
        tok = np.append(self.bytes[np.frombuffer(b"".join(pieces), np.uint8)], 0)
        owner = np.repeat(np.arange(len(pieces)), sizes)
        after, before = np.arange(1, n + 2), np.arange(-1, n)   # n: beyond either end
        ends = sizes.cumsum()
        after[ends - 1] = n
        before[ends - sizes] = n
        waits, alive = np.full(n + 1, -1, np.int64), np.ones(n, bool)
        has = np.flatnonzero(after[:n] < n)
        waits[has] = self._rank(tok[has], tok[after[has]])
        has = has[waits[has] >= 0]
        if len(has):
            self._put(waits[has], has)
        while self.high:
            rank, pos = self._take()
            pos = pos[waits[pos] == rank]                       # others are stale
            if len(pos) > 1:
                pos.sort()
                own = owner[pos]
                again = own[1:] == own[:-1]
                if again.any():
                    again = np.append(False, again)
                    rest = pos[again]
                    self._put(np.full(len(rest), rank), rest)
                    pos = pos[~again]
            elif not len(pos):
                continue
            gone = after[pos]
            nxt = after[gone]
            alive[gone] = False
            waits[gone] = -1
            after[pos] = nxt
            before[nxt] = pos
            tok[pos] = rank
            prev = before[pos]
            here, there = pos[nxt < n], prev[prev < n]
            waits[pos] = -1
            both = np.concatenate((here, there))
            if len(both):
                r = self._rank(tok[both], tok[after[both]])
                waits[both] = r
                both = both[r >= 0]
                if len(both):
                    self._put(r[r >= 0], both)
        out = tok[:n][alive].astype("<i4").tobytes()
        ends = (4 * np.bincount(owner[alive], minlength=len(pieces)).cumsum()).tolist()
        return [out[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Texts to ids, many texts at once.

    The pre-tokens of all the texts that are not remembered go through the batch
    queue together, those of over ``long`` bytes through a queue of their own.
    Pre-tokens up to 64 characters are remembered; when there are more than
    ``keep`` of them, only those of the texts just read stay.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN, keep: int = 400_000, long: int = 256):
        import regex
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.one, self.many = RankQueue(ranks), BatchQueue(ranks)
        self.keep, self.long = keep, long
        self.pieces: dict[str, bytes] = {}      # pre-token -> packed ids

    def _learn(self, pieces: set[str]) -> None:
        short, ranks = [], self.ranks
        for p in pieces:
            b = p.encode()
            whole = ranks.get(b)
            if whole is not None:
                self.pieces[p] = pack("<i", whole)
            elif len(b) > self.long:
                self.pieces[p] = np.array(self.one.encode(b), "<i4").tobytes()
            else:
                short.append((p, b))
        if short:
            self.pieces.update(zip([p for p, _ in short], self.many.encode_all([b for _, b in short])))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as 32-bit little-endian integers."""
        split = [self.find(t) if t else [] for t in texts]
        met = set().union(*split)
        new = met.difference(self.pieces)
        self._learn(new)
        get = self.pieces.__getitem__
        out = [b"".join(map(get, pieces)) for pieces in split]
        if len(self.pieces) > self.keep:
            self.pieces = {p: get(p) for p in met}
        for p in new:
            if len(p) > 64:
                del self.pieces[p]
        return out


def _shared(df: DataFrame, path: str):
    return Shared(df.sparkSession, load_ranks(path))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           pattern: str = PATTERN) -> DataFrame:
    """(id, ids): the ids of each whole text, each match of ``pattern`` merged
    separately, no special tokens.

    One row per input row, repeated rows included.  A null or empty text has
    no ids; a null id stays null.
    """
    shared = _shared(docs, path)

    @factory
    def make():
        enc = Encoder(shared.value, pattern)

        def work(key, text):
            packed = enc(text.to_pylist())
            ends = np.cumsum([0, *map(len, packed)]) // 4
            ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(packed))])
            return {"id": key, "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)}
        return work

    kind = docs.schema[id_col].dataType.simpleString()
    return map_texts(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), make,
                     f"id {kind}, ids array<int>", piece=8 << 20, raw=True)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(id, ids, bytes): the bytes that ``ids`` stand for; no ids, no bytes.

    Bytes, not text: ids cut anywhere need not be whole UTF-8 sequences.
    Raises on an id outside the vocabulary.
    """
    shared = _shared(encoded, path)

    @factory
    def make():
        words = {r: b for b, r in shared.value.items()}

        def work(key, ids):
            flat = list(map(words.__getitem__, ids.flatten().to_numpy().tolist()))
            ends = np.cumsum([0, *ids.value_lengths().fill_null(0).to_pylist()]).tolist()
            return {"id": key, "ids": ids, "bytes": [b"".join(flat[a:b]) for a, b in zip(ends, ends[1:])]}
        return work

    kind = encoded.schema["id"].dataType.simpleString()
    return map_texts(encoded.select("id", "ids"), make, f"id {kind}, ids array<int>, bytes binary", raw=True)
