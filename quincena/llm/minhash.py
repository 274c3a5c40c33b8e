"""Near duplicates: circulant MinHash, banding, exact verification.

Shingles are permuted once (sigma, a hash onto 32 bits), and coordinate k of
a signature is the least pi(sigma(x) + k * step) over a document's shingles:
one second permutation pi, circularly shifted, serves for all coordinates.

Documents with the same shingle set are one class. Classes meet in buckets
(equal bands of the signature). In each bucket every class is checked against
the bucket's first class; links found so join classes to components. In
buckets that still hold several components, members are checked against a
second one, the nearest to the first. A pair of one bucket that is in
different components after that may be linked as well: such pairs are all
checked but for those that bounds exclude for certain (sizes, and a bitmap of
the shingles). So no link
of a bucket is lost, while copies and dense groups never turn into all their
pairs. Every link is decided on full shingle sets.

With 24 bands of 3 rows a pair at similarity 0.75 meets in no bucket with
probability (1 - 0.75**3)**24 = 2e-6, and less above.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.llm.common import U64, arrow_slices, bounded, hash_words, mix64, run_hashes, utf8, words_of
from quincena.llm.exact import free_names, without_repeats
from quincena.session import materialize

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 24, 3
U32 = np.uint32
BLOCK = 1 << 14
CELLS = 1024
NAMELESS = 1 << 62
SHARE_ROWS = 256


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles (A-Z
    lower-cased; a text of fewer words is one shingle, one without words has none)."""
    out = []
    for t in texts:
        words = words_of(t.lower())
        h = run_hashes(hash_words(words), min(size, len(words)), len(words) if len(words) < size else size) \
            if words else np.empty(0, U64)
        out.append(np.unique(h))
    return out


def permute(x: np.ndarray) -> np.ndarray:
    """pi: a bijection of 32-bit integers (xor-shifts and odd multipliers)."""
    x ^= x >> U32(16)
    x *= U32(0x7FEB352D)
    x ^= x >> U32(15)
    x *= U32(0x846CA68B)
    x ^= x >> U32(16)
    return x


def signatures(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` for each non-empty set."""
    sets = [s for s in sets if len(s)]
    out = np.full((len(sets), coordinates), 0xFFFFFFFF, U32)
    lo = 0
    while lo < len(sets):  # blocks that stay in the processor's cache
        hi, total = lo, 0
        while hi < len(sets) and (hi == lo or total + len(sets[hi]) <= BLOCK):
            total += len(sets[hi])
            hi += 1
        sigma = (mix64(np.concatenate(sets[lo:hi])) >> U64(32)).astype(U32)
        starts = np.cumsum([0, *(len(s) for s in sets[lo:hi - 1])])
        for k in range(coordinates):
            out[lo:hi, k] = np.minimum.reduceat(permute(sigma + U32(k * 0x9E3779B1 & 0xFFFFFFFF)), starts)
        lo = hi
    return out


def _sign(bands: int, rows: int, size: int):
    def run(batches):
        import pyarrow as pa

        for part in arrow_slices(batches, "text"):
            sets = shingle_sets(part.column("text").to_pylist(), size)
            n = np.array([len(s) for s in sets], np.int64)
            sums = _sums(sets)
            signed = signatures(sets, bands * rows).astype(U64)
            band = np.zeros((len(sets), bands), U64)
            value = np.zeros((len(signed), bands), U64)
            for r in range(rows):
                value = mix64(value * U64(0x9E3779B97F4A7C15) + signed[:, r::rows])
            band[n > 0] = value
            flat = pa.array(band.view(np.int64).ravel(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("node"), pa.array(n), pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands, pa.int32()), flat)],
                names=["node", "n", "s1", "s2", "bands"])

    return run


def _sums(sets: list[np.ndarray]) -> list[list[int]]:
    """Two sums that tell sets of one size apart."""
    return [[int(mix64(s ^ U64(salt)).sum()) - (1 << 63) if len(s) else 0 for s in sets]
            for salt in (0x243F6A8885A308D3, 0x13198A2E03707344)]


def _sets(size: int):
    """Shingle sets of classes, from rows that may be theirs: a row whose set
    is another one's (its id stands on several texts) is passed over."""
    def run(batches):
        import pyarrow as pa

        for part in arrow_slices(batches, "text"):
            sets = shingle_sets(part.column("text").to_pylist(), size)
            is_its = np.array([len(s) for s in sets]) == part.column("n").to_numpy()
            for name, sums in zip(("s1", "s2"), _sums(sets), strict=True):
                is_its &= np.array(sums) == part.column(name).to_numpy()
            rows = np.flatnonzero(is_its)
            bits = np.zeros((len(rows), CELLS), np.uint8)
            for i, row in enumerate(rows):
                bits[i, sets[row] % U64(CELLS)] = 1
            words = np.packbits(bits, axis=1).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column("cls").take(pa.array(rows)), pa.array([sets[row].tobytes() for row in rows], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * (CELLS // 64), pa.int32()),
                                          pa.array(words.ravel()))], names=["cls", "shingles", "bits"])

    return run


def _compare(batches):
    """Sizes of intersections of the two sets of a row."""
    import pyarrow as pa

    for batch in batches:
        for part in arrow_slices([batch], "left"):
            common = [len(np.intersect1d(np.frombuffer(x, U64), np.frombuffer(y, U64), assume_unique=True))
                      for x, y in zip(part.column("left").to_pylist(), part.column("right").to_pylist(), strict=True)]
            sizes = [[len(x) // 8 for x in part.column(c).to_pylist()] for c in ("left", "right")]
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), pa.array(common, pa.int64()),
                 pa.array([x + y for x, y in zip(*sizes, strict=True)], pa.int64())], names=["a", "b", "common", "total"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b, distance, linked`` of each pair, from the full sets."""
    rows = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("left")), "a") \
        .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("right")), "b")
    union = F.col("total") - F.col("common")
    return bounded(rows.select("a", "b", "left", "right")).mapInArrow(_compare, "a long, b long, common long, total long").select(
        "a", "b", (1 - F.col("common") / union).alias("distance"),
        (100 * F.col("common") >= percent * union).alias("linked"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) over undirected links
    ``a, b``: nodes take the least label around them, then the label of their
    label, until nothing changes. Tables are written each round, which keeps
    plans short and survives lost executors."""
    edges = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                        "links")
    labels = materialize(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select(
        "node", F.least("node", "b").alias("component")), "labels")
    while True:
        around = edges.join(labels.select(F.col("node").alias("b"), F.col("component").alias("near")), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(around, "node").select("node", "component", F.least("component", "near").alias("low"))
        # The label of the label: a label is itself a node.
        jump = lower.join(labels.select(F.col("node").alias("low"), F.col("component").alias("beyond")), "low", "left")
        after = materialize(jump.select("node", F.least("low", F.coalesce("beyond", "low")).alias("low"),
                                        "component"), "labels")
        changed = after.filter("low < component").limit(1).count()
        labels = after.select("node", F.col("low").alias("component"))
        if not changed:
            return labels


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, bands: int = BANDS,
                    rows: int = ROWS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when their shingle sets' Jaccard similarity is at
    least ``percent`` hundredths; ``component_id`` is the least doc_id that
    links reach (itself included); ``kept``: it is that one. Texts that are
    null or without words are linked with nothing. ids are integers. Rows that
    share an id are one node, whatever their texts: links of each of them lead
    to all. A row without an id is compared like others; its component is the
    least id reached, and it is kept only where there is none. An empty table
    gives an empty one; other columns are left out."""
    # Rows without an id are known by their text: 62 bits of its hash, above usual ids.
    nameless = F.xxhash64(utf8(text)).bitwiseAND(F.lit(NAMELESS - 1)).bitwiseOR(F.lit(NAMELESS))
    nodes = docs.select(F.coalesce(F.col(doc_id).cast("long"), nameless).alias("node"), F.col(text).alias("text"))
    found = _components_of_nodes(nodes, percent, shingle, bands, rows)
    own = F.when(F.col("node") < NAMELESS, F.col("node"))
    return found.select(own.alias("doc_id"), "n_shingles", F.when(F.col("component") < NAMELESS, F.col("component")).alias("component_id")) \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _components_of_nodes(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE, bands: int = BANDS,
                         rows: int = ROWS) -> DataFrame:
    """``node, n_shingles, component, kept`` for each row of ``node, text``:
    the least node that links reach (nodes that stand for no id are greater than ids)."""
    ids = docs.select("node", utf8("text").alias("text"))
    signed = materialize(bounded(ids).mapInArrow(_sign(bands, rows, shingle),
                                        "node long, n long, s1 long, s2 long, bands array<long>"), "signatures")
    classes = materialize(signed.filter("n > 0").groupBy("n", "s1", "s2").agg(
        F.min(F.struct("node", "bands")).alias("first")).select("n", "s1", "s2", "first.*")
        .withColumn("cls", F.monotonically_increasing_id()), "classes")

    # Buckets with two classes or more; m: the bucket's first class.
    spread = classes.select("cls", "n", F.posexplode("bands").alias("band", "value"))
    first = spread.groupBy("band", "value").agg(F.min("cls").alias("m"), F.count(F.lit(1)).alias("members")) \
        .filter("members > 1").drop("members")
    members = materialize(spread.join(first, ["band", "value"]), "members")

    candidates = classes.drop("bands").join(members.select("cls").distinct(), "cls")
    # Of rows that repeat id and text one is read. Another text of the same id and set (blanks, capitals) only repeats a row of ``sets``.
    its = ids.join(candidates, "node").withColumn("h", F.xxhash64("text")).dropDuplicates(["node", "cls", "h"])
    sets = materialize(bounded(its.select("cls", "n", "s1", "s2", "text")).mapInArrow(
        _sets(shingle), "cls long, shingles binary, bits array<long>"), "sets")
    star = materialize(verified(members.filter("cls <> m").select(F.col("cls").alias("a"), F.col("m").alias("b"))
                                .distinct(), sets, percent), "star")
    links = star.filter("linked").select("a", "b").union(_one_node(signed, classes))
    groups = components(links)
    open_ = materialize(_open(members, groups), "open")
    if open_.limit(1).count():
        hubs = materialize(verified(_hub_pairs(open_, star), sets, percent).filter("linked").select("a", "b"), "hubs")
        links = links.union(hubs)
        groups = components(links)
        rest = materialize(_rest_pairs(materialize(_open(open_, groups), "open"), sets, percent), "rest")
        more = materialize(verified(rest, sets, percent).filter("linked").select("a", "b"), "more")
        if more.limit(1).count():
            groups = components(links.union(more))

    placed = classes.join(groups, classes["cls"] == groups["node"], "left").select(
        "n", "s1", "s2", classes["node"].alias("node"), F.coalesce("component", "cls").alias("component"))
    least = placed.groupBy("component").agg(F.min("node").alias("least"))
    labelled = placed.drop("node").join(least, "component").drop("component")
    return signed.join(labelled, ["n", "s1", "s2"], "left").select(
        "node", F.col("n").alias("n_shingles"), F.coalesce("least", "node").alias("component")).withColumn(
        "kept", F.col("node") == F.col("component"))


def _one_node(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``a, b`` between the classes of one id: the first with each other."""
    several = signed.filter("n > 0").select("node", "n", "s1", "s2").groupBy("node").agg(
        F.min(F.struct("n", "s1", "s2")).alias("low"), F.max(F.struct("n", "s1", "s2")).alias("high")).filter("low <> high")
    rows = signed.filter("n > 0").select("node", "n", "s1", "s2").join(several.select("node"), "node", "left_semi") \
        .distinct().join(classes.select("n", "s1", "s2", "cls"), ["n", "s1", "s2"])
    first = rows.groupBy("node").agg(F.min("cls").alias("a"))
    return rows.join(first, "node").filter("cls <> a").select("a", F.col("cls").alias("b")).distinct()


def _open(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    placed = members.drop("component").join(groups, members["cls"] == groups["node"], "left").select(
        "band", "value", "cls", "n", "m", F.coalesce("component", "cls").alias("component"))
    mixed = placed.groupBy("band", "value").agg(
        F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("band", "value")
    return placed.join(mixed, ["band", "value"])


def _hub_pairs(open_: DataFrame, star: DataFrame) -> DataFrame:
    """Each member of a bucket with the one that is nearest to its first
    class: of copies of one text the nearest is the least edited, and so the
    most likely to be linked with the others."""
    to_first = star.select(F.col("a").alias("cls"), F.col("b").alias("m"), "distance")
    near = open_.join(to_first, ["cls", "m"])
    hub = near.groupBy("band", "value").agg(
        F.min(F.struct("distance", "cls", "component")).alias("hub"))
    # The first class itself is not among them: it has been checked with all.
    return near.join(hub, ["band", "value"]).filter("component <> hub.component").select(
        F.least("cls", "hub.cls").alias("a"), F.greatest("cls", "hub.cls").alias("b")).distinct()


def _rest_pairs(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with one first class and different components that no bound
    excludes.

    ``bits`` says which of 1024 cells the shingles of a class fall into. Each
    cell of a that b leaves empty holds a shingle that only a has, so their
    intersection is at most n_a less the number of such cells, and likewise
    for b. One side of the join leaves out the largest component around a
    first class: its members need no check among themselves."""
    a, b = _blocks(open_.select("cls", "n", "m", "component").distinct().join(sets.select("cls", "bits"), "cls"))

    shared = sum((F.bit_count(F.col(f"a_w{i}").bitwiseAND(F.col(f"b_w{i}"))) for i in range(CELLS // 64)), F.lit(0))
    # At most this many common shingles; it stands once, as Spark would work it out at each place.
    common = shared + F.least(F.col("a_n") - F.col("a_cells"), F.col("b_n") - F.col("b_cells"))
    # A merge join holds one share of ``a`` at a time; ``b`` is many times the size its files tell, and must not be broadcast.
    pairs = b.join(a.hint("merge"), ["m", "share"]).filter(
        (F.col("a_component") != F.col("b_component"))
        & ((F.col("b_component") == F.col("main")) | (F.col("a_cls") < F.col("b_cls")))
        & (F.col("a_cls") != F.col("m")) & (F.col("b_cls") != F.col("m"))  # pairs with the first class are known
        & (100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
        & ((100 + percent) * common >= percent * (F.col("a_n") + F.col("b_n"))))
    return pairs.select(F.least("a_cls", "b_cls").alias("a"), F.greatest("a_cls", "b_cls").alias("b")).distinct()


def _blocks(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of the pairs of ``cls, n, m, component, bits`` around one
    first class ``m`` (columns ``a_...`` and ``b_...``): those outside its
    largest component (``main``), and all. The former are cut into shares of
    at most about ``SHARE_ROWS``, each of which meets all of the latter, so
    that the pairs of one large bucket are many tasks' work. Their number is
    fixed: few rows make many pairs here, and rows are what AQE would merge
    tasks by."""
    counted = rows.groupBy("m", "component").agg(F.count(F.lit(1)).alias("members")).groupBy("m").agg(
        F.max(F.struct("members", "component")).alias("most"), F.sum("members").alias("all"))
    main = counted.select("m", F.col("most.component").alias("main"),
                          F.ceil((F.col("all") - F.col("most.members")) / SHARE_ROWS).cast("int").alias("shares"))
    # The words of ``bits`` are columns of the written table: as aliases over ``bits`` below the join of the sides,
    # the optimizer would infer what equals ``cells`` once for each choice among them, 2 ** 16 times, in the driver.
    words = {f"w{i}": F.col("bits")[i] for i in range(CELLS // 64)}
    cells = sum((F.bit_count(w) for w in words.values()), F.lit(0))
    rows = materialize(rows.join(main.filter("shares > 0"), "m").select(
        "m", "main", "shares", "cls", "n", "component", cells.alias("cells"), *[w.alias(c) for c, w in words.items()]), "unlinked")
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)
    sides = (rows.filter("component <> main").withColumn("share", F.pmod(F.xxhash64("cls"), F.col("shares")).cast("int")),
             rows.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))))
    own = ("cls", "n", "component", "cells", *words)
    a, b = (side.select("m", "share", "main", *[F.col(c).alias(f"{s}_{c}") for c in own])
            .repartition(tasks, "m", "share") for s, side in zip("ab", sides, strict=True))
    return a, b.drop("main")


def keep_one_row(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` (all columns) with exactly one row of each component, whatever
    the ids: rows without an id are compared like any other, and rows that
    share an id but not the text are documents of their own. Rows with an id
    of their own stay before the others, the least id first. Rows of equal id
    and text are one document, of which any row stays."""
    # A row's node: its id, or where that is null or repeated 62 bits of a hash of the row, above usual ids.
    node_, id_, judged_ = free_names(docs.columns, "_node", "_id", "_judged")
    value, own = F.coalesce(F.col(text), F.lit("")), F.col(doc_id).cast("long")
    ids = docs.filter(F.col(doc_id).isNotNull()).groupBy(own.alias(id_)).agg(
        F.count(F.lit(1)).alias(judged_)).filter(F.col(judged_) > 1).select(id_)
    ids = materialize(ids, "repeated-ids")
    hashed = F.xxhash64(own, value).bitwiseAND(F.lit(NAMELESS - 1)).bitwiseOR(F.lit(NAMELESS))
    node = F.when(F.col(doc_id).isNull(), hashed).otherwise(own)
    rows = docs.withColumn(node_, node)
    if ids.limit(1).count():
        rows = docs.join(ids, own == F.col(id_), "left").withColumn(
            node_, F.when(F.col(id_).isNull(), node).otherwise(hashed)).drop(id_)
    near = _components_of_nodes(rows.select(F.col(node_).alias("node"), F.col(text).alias("text")), **options)
    judged = materialize(near.groupBy(F.col("node").alias(judged_)).agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")).filter("NOT kept OR n > 1"), "judged")
    return without_repeats(rows, judged.select(judged_), judged.filter("kept").select(judged_),
                           F.col(node_) == F.col(judged_), [node_]).drop(node_)
