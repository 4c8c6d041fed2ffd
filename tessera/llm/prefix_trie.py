"""Conversation prefix trie, built as a z-fast trie.

The trie over sequences of turns is kept compacted: a node for each place where
conversations part or end, and on the edge above it all the turns that lead there.
A node with parent depth p and own depth e is filed under one hash only, that of
its first f turns, where f is the two-fattest number in (p, e] (divisible by the
highest power of two): its handle.  A conversation finds where it leaves the trie
by fat binary search: it looks up the prefix whose length is the two-fattest
number of the range still open, which halves the range, so a conversation of n
turns takes about log2(n) lookups, all conversations at once by a join.

Conversations are inserted in batches.  All that are not yet in the trie look for
their exit; of those that leave it at one place by one next turn, the one with the
smallest id is inserted, edges are split where it leaves them, and the others
look again in the next batch, now at least one turn deeper.  Equal conversations
are one from the start.  When all are in, edges are expanded into the nodes of
every depth.

Prefixes are known by 128 bits: the XOR over their turns of two hashes of (turn,
place).  Turns of a conversation lie in chunks of at most ``CHUNK`` rows and texts
are hashed where they are read, so a conversation of any length, or a prefix that
any number of conversations share, is never in one task's memory; joins with a hot
prefix are split by Spark's adaptive skew handling.  Every table between steps is
written to the shared folder.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import arrow_schema, cut_lineage

#: Turns of one conversation in one row at most.
CHUNK = 128
#: Members that end at one node whose ids are joined in one row at most.
ENDS = 10_000
WORDS = r"[^\x20\x09-\x0D]+"
_TURNS = "array<struct<k1:bigint,k2:bigint,w:bigint,own:bigint>>"


def in_order(convs: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, pos, turn_hash, words): rows by place in their conversation, from 1.

    Sorted by range, numbered within partitions; only conversations that cross
    partitions need an offset, one row for each partition that they reach.
    """
    text, role = F.coalesce(convs[text_col], F.lit("")), F.coalesce(convs[role_col], F.lit(""))
    rows = convs.where(convs[id_col].isNotNull()).select(
        convs[id_col].cast("long").alias("conv"), convs[turn_col].alias("turn"), role.alias("role"),
        F.unhex(F.sha2(text, 256)).alias("sha"), F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))
    order = ["turn", "role", "sha"]
    rows = cut_lineage(cut_lineage(rows).repartitionByRange("conv", *order).withColumn("pid", F.spark_partition_id()))
    local = F.row_number().over(Window.partitionBy("pid", "conv").orderBy(*order))
    before = F.sum("count").over(Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1))
    offsets = rows.groupBy("conv", "pid").count().select("conv", "pid", before.alias("before")).where("before is not null")
    return (rows.withColumn("local", local).join(F.broadcast(offsets), ["conv", "pid"], "left")   # a row a partition
            .select("conv", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"),
                    F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", F.hex("sha")), 256))
                    .alias("turn_hash"), "words"))


def rebuilt(turns: DataFrame, heads: int, stride: int) -> tuple[DataFrame, DataFrame]:
    """The conversations as chunks (conv, c, lo, keys) of prefix keys, the first
    of depth lo + 1, and (conv, len, shift, k1, k2): length, depth minus place of
    own turns, and key of all."""
    chunks = cut_lineage(turns.groupBy("conv", F.floor((F.col("pos") - 1) / CHUNK).alias("c"))
                         .agg(F.array_sort(F.collect_list(F.struct("pos", "turn_hash", "words"))).alias("turns")))
    sizes = chunks.groupBy("conv").agg(F.max(F.col("c") * CHUNK + F.size("turns")).alias("n"))
    lead = chunks.where(f"c = 0 and conv % {stride} = 0").select(
        F.col("conv").alias("base"), F.slice("turns", 1, heads - 1).alias("lead"))
    known = (sizes.withColumn("h", (F.crc32(F.col("conv").cast("string")) % heads).cast("int"))
             .withColumn("base", F.expr(f"conv - conv % {stride}")).join(lead, "base", "left")
             .withColumn("lead", F.expr("slice(coalesce(lead, array()), 1, h)"))
             .withColumn("shift", (F.size("lead") - F.col("h")).cast("long")))
    rows = (chunks.join(known, "conv")
            .withColumn("turns", F.expr("concat(if(c = 0, lead, slice(lead, 1, 0)), filter(turns, t -> t.pos > h))"))
            .withColumn("lo", F.expr(f"if(c = 0, 0, c * {CHUNK} + shift)"))
            .withColumn("turns", F.expr("transform(turns, (t, i) -> named_struct('h1', xxhash64(t.turn_hash, lo + i, 1),"
                                        " 'h2', xxhash64(t.turn_hash, lo + i, 2), 'words', t.words))"))
            .withColumn("keys", F.expr(
                f"aggregate(turns, named_struct('k1', 0L, 'k2', 0L, 'w', 0L, 'out', cast(array() as {_TURNS})), (a, t) -> "
                "named_struct('k1', a.k1 ^ t.h1, 'k2', a.k2 ^ t.h2, 'w', a.w + t.words, 'out', concat(a.out, array("
                "named_struct('k1', a.k1 ^ t.h1, 'k2', a.k2 ^ t.h2, 'w', a.w + t.words, 'own', t.words)))), a -> a.out)"))
            .select("conv", "c", "lo", "shift", "n", "keys"))
    last = F.element_at("keys", F.when(F.size("keys") > 0, -1))
    rows = cut_lineage(rows)
    # conversations of several chunks: each chunk goes on from those before it
    long = rows.where(F.col("n") > CHUNK)
    past = Window.partitionBy("conv").orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
    carry = (long.select("conv", "c", last.alias("last"))
             .select("conv", "c", F.bit_xor("last.k1").over(past).alias("x1"), F.bit_xor("last.k2").over(past).alias("x2"),
                     F.sum("last.w").over(past).alias("xw")).where("x1 is not null"))
    long = long.join(carry, ["conv", "c"], "left").withColumn("keys", F.expr(
        "if(x1 is null, keys, transform(keys, k -> named_struct('k1', k.k1 ^ x1, 'k2', k.k2 ^ x2, 'w', k.w + xw, 'own', k.own)))"))
    chunks = cut_lineage(rows.where(F.col("n") <= CHUNK).union(long.select(*rows.columns)))
    ends = chunks.select("conv", "c", "shift", (F.col("lo") + F.size("keys")).alias("len"), last["k1"].alias("k1"),
                         last["k2"].alias("k2"), "n")
    whole = ends.where(F.col("n") <= CHUNK).drop("c", "n").union(
        ends.where(F.col("n") > CHUNK).groupBy("conv").agg(F.max(F.struct("len", "c", "shift", "k1", "k2")).alias("x"))
        .select("conv", "x.shift", "x.len", "x.k1", "x.k2"))
    whole = whole.select("conv", "len", "shift", F.coalesce("k1", F.lit(0)).alias("k1"), F.coalesce("k2", F.lit(0)).alias("k2"))
    return chunks.drop("shift", "n"), cut_lineage(whole)


def key_at(rows: DataFrame, chunks: DataFrame, conv: str, shift: str, depth: str, name: str) -> DataFrame:
    """Adds ``name``: key and words of the first ``depth`` (an expression) turns
    of conversation ``conv``; those of the root at depth 0, null at null."""
    own = rows.columns
    side = chunks.select(F.col("conv").alias("__conv"), F.col("c").alias("__c"), F.col("lo").alias("__lo"), "keys")
    got = (rows.withColumn("__d", F.expr(depth).cast("long"))
           .withColumn("__at", F.expr(f"if(__d > 0, greatest(0L, (__d - {shift} - 1) div {CHUNK}), null)")))
    got = got.join(side, (got[conv] == side["__conv"]) & (got["__at"] == side["__c"]), "left")
    found = F.expr("if(__d = 0, named_struct('k1', 0L, 'k2', 0L, 'w', 0L, 'own', 0L), "
                   "if(__d > 0, get(keys, cast(__d - __lo - 1 as int)), null))")
    return got.select(*own, found.alias(name))


def fattest(lo: str, hi: str) -> str:
    """SQL of the number in (lo, hi] that the highest power of two divides."""
    bit = f"(length(bin({lo} ^ {hi})) - 1)"
    return f"shiftleft(shiftright({hi}, {bit}), {bit})"


_NODE = ["k1", "k2", "ext", "p1", "p2", "par", "rep", "rep_shift", "h1", "h2", "f1", "f2"]
_EMPTY = ("k1 long, k2 long, ext long, p1 long, p2 long, par long, rep long, rep_shift long, h1 long, h2 long, "
          "f1 long, f2 long")


def filed(nodes: DataFrame, chunks: DataFrame) -> DataFrame:
    """Nodes (key, ext, parent's key, par, rep) with the keys of their handle and
    of the first turn of their edge."""
    got = key_at(nodes, chunks, "rep", "rep_shift", fattest("par", "ext"), "h")
    got = key_at(got, chunks, "rep", "rep_shift", "par + 1", "f")
    return got.withColumns({"h1": F.col("h.k1"), "h2": F.col("h.k2"), "f1": F.col("f.k1"), "f2": F.col("f.k2")}).select(*_NODE)


def exits(pending: DataFrame, nodes: DataFrame, chunks: DataFrame, lookups: int) -> DataFrame:
    """Where each conversation leaves the trie: ``node`` is the deepest one whose
    handle it begins with (null: the root), ``whole`` whether it begins with all of
    it, ``next`` the key one turn further, ``edge`` the node on whose edge it
    then is, if on any."""
    about = F.struct("k1", "k2", "ext", "p1", "p2", "par", "rep", "rep_shift")
    by_handle = nodes.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2"), about.alias("__found"))
    by_first = nodes.select(F.col("f1").alias("__f1"), F.col("f2").alias("__f2"), about.alias("child"))
    st = pending.withColumns({"a": F.lit(0).cast("long"), "b": F.col("len"), "node": F.lit(None).cast(
        by_handle.schema["__found"].dataType)})
    for _ in range(lookups):
        st = st.withColumn("f", F.expr(f"if(a < b, {fattest('a', 'b')}, null)"))
        st = key_at(st, chunks, "conv", "shift", "f", "probe")
        st = st.join(by_handle, (F.col("probe.k1") == F.col("__h1")) & (F.col("probe.k2") == F.col("__h2")), "left")
        hit = F.col("__found").isNotNull()
        st = st.select(*pending.columns, F.when(hit, F.col("__found.ext")).otherwise(F.col("a")).alias("a"),
                       F.when(hit | F.col("f").isNull(), F.col("b")).otherwise(F.col("f") - 1).alias("b"),
                       F.coalesce("__found", "node").alias("node"))
    st = key_at(st, chunks, "conv", "shift", "if(node.ext <= len, node.ext, null)", "there")
    st = st.withColumn("whole", F.expr("node is null or coalesce(there.k1 = node.k1 and there.k2 = node.k2, false)"))
    st = key_at(st, chunks, "conv", "shift", "if(whole and coalesce(node.ext, 0L) < len, coalesce(node.ext, 0L) + 1, null)", "next")
    st = st.join(by_first, (F.col("next.k1") == F.col("__f1")) & (F.col("next.k2") == F.col("__f2")), "left")
    return st.select(*pending.columns, "node", "whole", "next", F.expr("if(whole, child, node)").alias("edge"))


def on_edges(found: DataFrame, chunks: DataFrame) -> DataFrame:
    """(conv, x): how many turns conversations that leave on an edge share with
    the trie: the deepest of their prefixes that the edge holds too."""
    def prefixes(rows, low, high):
        return (chunks.join(rows, "conv")
                .select("conv", F.expr("explode(filter(transform(keys, (k, i) -> named_struct('k1', k.k1, 'k2', k.k2, 'd', "
                                       f"lo + i + 1)), k -> k.d > {low} and k.d <= {high}))").alias("k")).select("conv", "k.*"))
    edges = found.select(F.col("edge.rep").alias("conv"), "edge.par", "edge.ext").distinct()
    held = prefixes(edges, "par", "ext").select("k1", "k2").distinct()
    mine = prefixes(found.select("conv", "len", F.col("edge.par").alias("par"), F.col("edge.ext").alias("ext")),
                    "par", "least(len, ext)")
    return mine.join(held, ["k1", "k2"], "left_semi").groupBy("conv").agg(F.max("d").alias("x"))


def inserted(nodes: DataFrame, leaders: DataFrame, chunks: DataFrame) -> DataFrame:
    """The trie with the ``leaders`` in it: leaves below their exits, and edges
    split at the depths where any of them leave."""
    rep, key = [F.col("conv").alias("rep"), F.col("shift").alias("rep_shift")], [F.col("k1"), F.col("k2")]
    leaves = leaders.where("x < len").select(*key, F.col("len").alias("ext"), F.col("at.k1").alias("p1"),
                                             F.col("at.k2").alias("p2"), F.col("x").alias("par"), *rep)
    split = leaders.where("edge is not null")
    points = split.groupBy("edge", F.col("at.k1").alias("k1"), F.col("at.k2").alias("k2"), F.col("x").alias("ext")).agg(
        F.min(F.struct("conv", "shift")).alias("rep"))
    points = points.select("edge", "k1", "k2", "ext", F.col("rep.conv").alias("rep"), F.col("rep.shift").alias("rep_shift"))
    whole = split.select("edge").distinct().select("edge", "edge.k1", "edge.k2", "edge.ext", "edge.rep", "edge.rep_shift")
    chain = Window.partitionBy("edge").orderBy("ext")
    parts = points.union(whole).select(
        "edge", "k1", "k2", "ext", F.coalesce(F.lag("k1").over(chain), F.col("edge.p1")).alias("p1"),
        F.coalesce(F.lag("k2").over(chain), F.col("edge.p2")).alias("p2"),
        F.coalesce(F.lag("ext").over(chain), F.col("edge.par")).alias("par"), "rep", "rep_shift").drop("edge")
    cut = whole.select("k1", "k2")
    return nodes.join(cut, ["k1", "k2"], "left_anti").select(*_NODE).union(filed(leaves.union(parts), chunks))


def trie(convs: DataFrame, chunks: DataFrame) -> DataFrame:
    """The compacted nodes of all conversations, the root left out."""
    spark = convs.sparkSession
    nodes = spark.createDataFrame([], _EMPTY)
    pending = cut_lineage(convs.where("len > 0").groupBy("k1", "k2").agg(F.min(F.struct("conv", "len", "shift")).alias("x"))
                          .select("x.*", "k1", "k2"))
    first = True
    while True:
        longest = pending.agg(F.max("len")).first()[0]
        if longest is None:
            return nodes
        found = cut_lineage(exits(pending, nodes, chunks, 0 if first else int(longest).bit_length())
                            .where("not whole or coalesce(node.ext, 0L) < len"))
        first = False
        edge = found.where("edge is not null")
        x = edge.join(on_edges(edge, chunks), "conv", "left").withColumn("x", F.coalesce("x", "edge.par"))
        out = found.where("edge is null").withColumn("x", F.expr("coalesce(node.ext, 0L)"))
        both = out.unionByName(x.select(*out.columns))
        both = key_at(both, chunks, "conv", "shift", "x", "at")
        both = key_at(both, chunks, "conv", "shift", "least(x + 1, len)", "slot")
        leaders = cut_lineage(both.groupBy("slot.k1", "slot.k2").agg(F.min(F.struct(
            "conv", "len", "shift", F.struct("k1", "k2").alias("key"), "x", "at", "edge")).alias("lead"))
            .select("lead.*").select("conv", "len", "shift", "key.*", "x", "at", "edge"))
        nodes = cut_lineage(inserted(nodes, leaders, chunks))
        pending = cut_lineage(found.join(leaders.select("conv"), "conv", "left_anti").select(*pending.columns))


def end_digests(convs: DataFrame) -> DataFrame:
    """(k1, k2, n_ends, first, ends): of the conversations that are one sequence
    their number, the smallest id, and the SHA-256 of all ids.

    More than ``ENDS`` are hashed as a stream: tasks join runs of sorted ids into
    pieces, and one task feeds a group's pieces to the hash, which is sequential."""
    groups = cut_lineage(convs.groupBy("k1", "k2").agg(F.count("*").alias("n_ends"), F.min("conv").alias("first")))
    small = (convs.join(groups.where(F.col("n_ends") <= ENDS), ["k1", "k2"]).groupBy("k1", "k2", "n_ends", "first")
             .agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("conv"))), 256).alias("ends")))
    hot = groups.where(F.col("n_ends") > ENDS)      # fewer than an ENDS-th of the conversations
    if hot.isEmpty():
        return small
    piece, done = "k1 long, k2 long, conv long, ids string", "k1 long, k2 long, ends string"
    shapes = arrow_schema(piece), arrow_schema(done)

    def join_runs(batches):
        for b in batches:
            k1, k2, ids = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            at = 0
            while at < len(ids):
                end = at + 1
                while end < len(ids) and end - at < 50_000 and k1[end] == k1[at] and k2[end] == k2[at]:
                    end += 1
                yield pa.RecordBatch.from_pydict({"k1": [k1[at]], "k2": [k2[at]], "conv": [ids[at]], "ids": [
                    ",".join(map(str, ids[at:end].tolist()))]}, shapes[0])
                at = end

    def feed(batches):
        now, sha = None, None
        for b in batches:
            for k1, k2, _, ids in zip(*[c.to_pylist() for c in b.columns]):
                if (k1, k2) == now:
                    sha.update(b"," + ids.encode())
                    continue
                if now:
                    yield pa.RecordBatch.from_pydict({"k1": [now[0]], "k2": [now[1]], "ends": [sha.hexdigest()]}, shapes[1])
                now, sha = (k1, k2), hashlib.sha256(ids.encode())
        if now:
            yield pa.RecordBatch.from_pydict({"k1": [now[0]], "k2": [now[1]], "ends": [sha.hexdigest()]}, shapes[1])

    many = convs.join(hot, ["k1", "k2"], "left_semi").select("k1", "k2", "conv")
    pieces = (cut_lineage(many).repartitionByRange("k1", "k2", "conv").sortWithinPartitions("k1", "k2", "conv")
              .mapInArrow(join_runs, piece))
    digests = pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv").mapInArrow(feed, done)
    return small.union(hot.join(digests, ["k1", "k2"]).select("k1", "k2", "n_ends", "first", "ends"))


def prefix_nodes(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", heads: int = 4, stride: int = 20) -> DataFrame:
    """One row per distinct sequence of first turns, the root (no turns) included:
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.

    Turns go by ``turn``, null first, ties by role and then by the SHA-256 of the
    text; null roles and texts are empty; repeated rows are turns each; rows with a
    null id belong to no conversation.  Conversation c is rebuilt: of h = crc32(c)
    mod ``heads``, it starts with the first h turns of conversation c - c mod
    ``stride`` (fewer if that has fewer), then come its own turns after its
    first h.  ``conv_id`` is the smallest of the ``n_convs`` conversations
    that start with the node; ``n_leaves`` counts the childless nodes below and at
    it, ``saved_tokens`` sums (n_convs - 1) * words of the node's last text over the
    same; ``ends_sha256`` is that of the sorted, comma-joined ids that are just it.
    Without conversations there is no root either.
    """
    spark = conversations.sparkSession
    chunks, convs = rebuilt(in_order(conversations, id_col, turn_col, role_col, text_col), heads, stride)
    nodes = trie(convs, chunks)
    ends = cut_lineage(end_digests(convs))
    children = nodes.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("n_children"))
    known = key_at(nodes, chunks, "rep", "rep_shift", "ext", "low")
    known = key_at(known, chunks, "rep", "rep_shift", "par", "high")
    known = cut_lineage(known.join(children, ["k1", "k2"], "left").join(ends, ["k1", "k2"], "left").select(
        "k1", "k2", "ext", "p1", "p2", "par", "rep", F.col("low.w").alias("words_to"), (F.col("low.w") - F.col("high.w")).alias("edge_words"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_ends", F.lit(0)).alias("n_ends"), "first", "ends"))
    # every compacted node with those above it, itself included: the prefixes of its path that are nodes
    path = (chunks.join(known.select(F.col("rep").alias("conv"), F.col("k1").alias("g1"), F.col("k2").alias("g2"), "ext",
                                     "n_ends", "first", "n_children", "edge_words"), "conv")
            .select("g1", "g2", "n_ends", "first", "n_children", "edge_words", F.expr(
                "explode(slice(keys, 1, cast(greatest(0L, least(ext - lo, cast(size(keys) as bigint))) as int)))").alias("k")))
    above = cut_lineage(path.select("g1", "g2", "n_ends", "first", "n_children", "edge_words", "k.k1", "k.k2")
                        .join(known.select("k1", "k2"), ["k1", "k2"], "left_semi"))
    count = above.groupBy("k1", "k2").agg(F.sum("n_ends").alias("n_convs"), F.min("first").alias("conv_id"),
                                          F.sum((F.col("n_children") == 0).cast("long")).alias("n_leaves"))
    count = cut_lineage(count)
    own = count.select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), (F.col("n_convs") - 1).alias("again"))
    below = (above.where("g1 <> k1 or g2 <> k2").join(own, ["g1", "g2"]).groupBy("k1", "k2")
             .agg(F.sum(F.col("again") * F.col("edge_words")).alias("below")))
    full = cut_lineage(known.join(count, ["k1", "k2"]).join(below, ["k1", "k2"], "left")
                       .withColumn("below", F.coalesce("below", F.lit(0))))
    total = convs.agg(F.count("*").alias("n"), F.min("conv").alias("lo")).first()
    if not total.n:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                         "n_leaves long, saved_tokens long, ends_sha256 string")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    top = ends.where("k1 = 0 and k2 = 0").select("ends").first()
    root = full.agg(F.lit(total.lo).alias("conv_id"), F.lit(0).cast("long").alias("depth"),
                    F.lit(None).cast("long").alias("parent_conv_id"), F.lit(total.n).alias("n_convs"),
                    F.count_if(F.col("par") == 0).alias("n_children"),
                    F.greatest(F.count_if(F.col("n_children") == 0), F.lit(1)).alias("n_leaves"),
                    F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("edge_words")), F.lit(0)).alias("saved_tokens"),
                    (F.lit(top.ends) if top else empty).alias("ends_sha256"))
    parents = full.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent"))
    edges = full.join(parents, ["p1", "p2"], "left").withColumn("parent", F.expr(f"if(par = 0, {total.lo}L, parent)"))
    rows = (chunks.withColumnRenamed("conv", "rep").join(edges, "rep")
            .select("edge_words", "conv_id", "parent", "par", "ext", "n_convs", "n_children", "n_leaves", "below", "words_to",
                    "ends", F.expr("explode(filter(transform(keys, (k, i) -> named_struct('d', lo + i + 1, 'w', k.w, 'own', k.own)),"
                                   " k -> k.d > par and k.d <= ext))").alias("k")))
    at = F.col("k.d") == F.col("ext")
    expanded = rows.select(
        "conv_id", F.col("k.d").cast("long").alias("depth"),
        F.when(F.col("k.d") == F.col("par") + 1, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        F.when(at, F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * (F.col("words_to") - F.col("k.w") + F.col("k.own"))).alias("saved_tokens"),
        F.when(at, F.coalesce("ends", empty)).otherwise(empty).alias("ends_sha256"))
    return root.unionByName(expanded)
