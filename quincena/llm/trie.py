"""Prefix trie of conversations.

A turn is written as a code of fixed width (a hash of role and text, and the
text's length), a conversation as the string of its turns' codes, its path.
Paths sort like the sequences they stand for, a prefix before what extends it.
Distinct paths are cut into range shards. Each shard encodes its turns by a
dictionary, builds a ternary search tree of its paths, inserted from the
median outwards so that it is balanced, and walks it once, without recursion,
from the last node made to the first: a node is made after the one above it,
so members, leaves and savings have reached a node when its turn comes.

A node stands in more than one shard only if it lies on the border, that is on
the common prefix of the last path of a shard and the first of the next.
Shards know how long those prefixes are, and count of what they share only
what the shard before has not counted. So border nodes add up: one aggregate
merges them, however many shards they run through.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quincena.llm.common import bounded
from quincena.session import materialize

HASHED, WIDTH = 32, 40          # characters of a code: 32 of the hash, 8 of the length
SHARD_CHARACTERS = 8 << 20      # of paths in a shard: some 200,000 turns
NO_ENDS = hashlib.sha256(b"").hexdigest()


def paths(conversations: DataFrame, every: int = 100, most: int = 6, conv_id: str = "conv_id", turn: str = "turn",
          role: str = "role", text: str = "text") -> DataFrame:
    """``conv, path`` of every rebuilt conversation: the first h turns of the
    conversation whose id is the next lower multiple of ``every`` and then its
    own turns after the first h; h is the id's crc32 modulo ``most`` (ids
    below 0: with SQL's ``%``). Texts do not leave the scan: shuffles carry codes."""
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    code = F.concat(F.substring(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256), 1, HASHED),
                    F.lpad(F.hex(F.length(said)), WIDTH - HASHED, "0"))
    turns = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.struct(F.col(turn).alias("turn"), who.alias("role"),
                                                           code.alias("code")).alias("said"))
    own = materialize(turns.groupBy("conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("said")), lambda t: t["code"]), "").alias("own")), "turn-codes")
    base = own.filter(F.col("conv") % every == 0).select(
        F.col("conv").alias("base"), F.substring("own", 1, (most - 1) * WIDTH).alias("lead"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most * WIDTH).cast("int")
    return own.join(base, F.col("conv") - F.col("conv") % every == F.col("base"), "left").select(
        "conv", F.concat(F.substr(F.coalesce("lead", F.lit("")), F.lit(1), h), F.substr("own", h + 1)).alias("path"))


def _key(path):
    return F.substring(F.sha2(path, 256), 1, HASHED)


def _ends(batches):
    """Hash of the ids of every run of equal keys (rows come sorted)."""
    import pyarrow as pa

    key, digest = None, None
    for batch in batches:
        out = []
        ids = batch.column("conv").to_pylist()
        for k, i in zip(batch.column("key").to_pylist(), ids, strict=True):
            if k != key:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(b"%d" % i)
            else:
                digest.update(b",%d" % i)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out, strict=True)], names=["key", "ends"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([digest.hexdigest()])], names=["key", "ends"])


def _borders(batches):
    """How many turns a shard's ends have in common with their neighbours (-1:
    there is none), and whether the next shard extends the last path."""
    import pyarrow as pa

    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            before, after = (-1 if None in pair else len(os.path.commonprefix(pair)) // WIDTH
                             for pair in ([r["previous"], r["first"]], [r["last"], r["next"]]))
            rows.append((r["shard"], before, after, after * WIDTH == len(r["last"])))
        if rows:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                             names=["shard", "before", "after", "extended"])


class SearchTree:
    """Ternary search tree. A node stands for a prefix; ``low`` and ``high``
    lead to prefixes with another last turn, ``down`` to one turn more."""

    def __init__(self):
        self.turn, self.up, self.depth = [-1], [-1], [0]
        self.low, self.down, self.high = [-1], [-1], [-1]

    def _new(self, turn: int, up: int) -> int:
        node = len(self.turn)
        for column, value in ((self.turn, turn), (self.up, up), (self.depth, self.depth[up] + 1),
                              (self.low, -1), (self.down, -1), (self.high, -1)):
            column.append(value)
        return node

    def insert(self, turns: list[int]) -> list[int]:
        """The nodes of all prefixes, from the root."""
        way = [0]
        for t in turns:
            at, links = way[-1], self.down
            node = links[at]
            while node >= 0 and self.turn[node] != t:
                at, links = node, self.low if t < self.turn[node] else self.high
                node = links[at]
            if node < 0:
                node = links[at] = self._new(t, way[-1])
            way.append(node)
        return way


def medians(n: int):
    """0 .. n-1, each range's middle before its halves."""
    waiting = [(0, n)]
    while waiting:
        lo, hi = waiting.pop()
        if lo < hi:
            middle = (lo + hi) // 2
            yield middle
            waiting += [(middle + 1, hi), (lo, middle)]


NODE = ("key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")


def _grow(table):
    """Nodes of one shard; border nodes and nodes below them with keys."""
    import pyarrow as pa

    table = table.sort_by("path")
    texts = table.column("path").to_pylist()
    before, after, extended = (table.column(c)[0].as_py() for c in ("before", "after", "extended"))
    cut = [[p[i:i + WIDTH] for i in range(0, len(p), WIDTH)] for p in texts]
    codes = sorted({c for p in cut for c in p})
    number = {c: i for i, c in enumerate(codes)}
    tree, ways = SearchTree(), {}
    ends = [0] * len(texts)
    for i in medians(len(texts)):
        way = tree.insert([number[c] for c in cut[i]])
        ends[i] = way[-1]
        if i in (0, len(texts) - 1):
            ways[i] = way
    size = len(tree.turn)
    key: list[str | None] = [None] * size
    for i, shared in ((0, before), (len(texts) - 1, after)):
        for d in range(shared + 1):
            key[ways[i][d]] = hashlib.sha256(texts[i][:d * WIDTH].encode()).hexdigest()[:HASHED]
    counted = set(ways[0][:before + 1])  # by a shard before this one
    lengths = [int(c[HASHED:], 16) for c in codes]

    members, least, digest = [0] * size, [None] * size, [None] * size
    kids, leaves, saved = [0] * size, [0] * size, [0] * size
    for i, (n, conv, end) in enumerate(zip(*(table.column(c).to_pylist() for c in ("n", "conv", "ends")), strict=True)):
        members[ends[i]], least[ends[i]], digest[ends[i]] = n, conv, end
    goes_on = ends[-1] if extended else -1
    for node in range(size - 1, -1, -1):
        if tree.down[node] < 0 and node != goes_on:
            leaves[node] += 1
        if not node:
            break
        up, fresh = tree.up[node], node not in counted
        saved[node] += (members[node] - fresh) * lengths[tree.turn[node]]
        kids[up] += fresh
        members[up] += members[node]
        leaves[up] += leaves[node]
        saved[up] += saved[node]
        least[up] = least[node] if least[up] is None else min(least[up], least[node])
    above = [None if u < 0 else key[u] for u in tree.up]
    return pa.table({"key": pa.array(key, pa.string()), "parent_key": pa.array(above, pa.string()), "conv_id": least,
                     "depth": tree.depth, "parent_conv_id": pa.array([None if u < 0 else least[u] for u in tree.up], pa.int64()),
                     "n_convs": members, "n_children": kids, "n_leaves": leaves, "saved_tokens": saved,
                     "ends_sha256": pa.array(digest, pa.string())})


def nodes(rebuilt: DataFrame, shard_characters: int = SHARD_CHARACTERS) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256`` of every node of the trie of ``conv, path``.

    A path that very many conversations share is one row of its shard; only
    its conversations' ids (8 bytes each) run through one task, sorted on disk
    where they must be, since a hash of their ordered list is asked for. A
    path itself is held whole: 40 characters a turn."""
    rows = materialize(rebuilt.withColumn("key", _key("path")), "paths")
    ended = bounded(rows.select("key", "conv").repartition("key").sortWithinPartitions("key", "conv")).mapInArrow(
        _ends, "key string, ends string")
    distinct = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"))
    distinct = materialize(distinct.withColumn("key", _key("path")).join(ended, "key").drop("key"), "distinct-paths")
    shards = -(-(distinct.agg(F.sum(F.length("path"))).first()[0] or 1) // shard_characters) or 1
    dealt = materialize(distinct.repartitionByRange(shards, "path").withColumn("shard", F.spark_partition_id()), "shards")
    order = Window.orderBy("shard")  # one row a shard
    edges = dealt.groupBy("shard").agg(F.min("path").alias("first"), F.max("path").alias("last")).withColumns({
        "previous": F.lag("last").over(order), "next": F.lead("first").over(order)})
    borders = bounded(edges).mapInArrow(_borders, "shard int, before long, after long, extended boolean")
    grown = materialize(dealt.join(borders, "shard").groupBy("shard").applyInArrow(_grow, NODE), "nodes")

    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = grown.filter("key IS NOT NULL").groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"), *(F.sum(c).alias(c) for c in sums),
        F.max("ends_sha256").alias("ends_sha256"))
    merged = materialize(merged.select(*grown.columns), "border-nodes")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("merged_parent"))
    return grown.filter("key IS NULL").union(merged).join(above, "parent_key", "left").select(
        "conv_id", "depth", F.coalesce("merged_parent", "parent_conv_id").alias("parent_conv_id"), *sums,
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def prefix_trie(conversations: DataFrame, every: int = 100, most: int = 6, shard_characters: int = SHARD_CHARACTERS,
                **columns: str) -> DataFrame:
    """The nodes (see ``nodes``) of all rebuilt conversations (see ``paths``).

    Turns are ordered by turn, null first; of equal turns the role and then
    the turn's hash decide. A null role or text is empty. Rows without a
    conversation id belong to none and are left out; repeated rows are turns
    of their own. A conversation of which nothing is left counts for the root.
    An empty table has no node. Other columns are left out."""
    return nodes(paths(conversations, every, most, **columns), shard_characters)
