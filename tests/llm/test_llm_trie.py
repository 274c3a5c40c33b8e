"""op13: the conversation trie against brute force."""

import hashlib
import math
import random
import zlib

import pytest
from llm_helpers import workers  # noqa: F401
from pyspark.sql import types as T

from conftest import SF0001
from quincena.llm import trie

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       T.StructField("path", T.StringType()), T.StructField("key", T.StringType()),
                       T.StructField("shard", T.StringType())])


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))  # ids below 0: as SQL has %
        made[c] = own.get(base, [])[:h] + v[h:]
    members = {}
    for c, v in made.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    children = {}
    for n in members:
        if n:
            children.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        below = children.get(n, [])
        leaves[n] = sum(leaves[b] for b in below) or 1
        saved[n] = sum(saved[b] for b in below) + ((len(members[n]) - 1) * len(n[-1][1]) if n else 0)
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(children.get(n, [])), leaves[n], saved[n],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(made[c]) == len(n)).encode()).hexdigest())
                  for n, m in members.items()) if members else []


def got(df, **options):
    return sorted(map(tuple, trie.prefix_trie(df, **options).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()))


def order(rows):
    return sorted(rows, key=str)


def talk(seed, n, vocabulary):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(500), n):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(vocabulary)))
    return rows


def frame(spark, rows):
    full = [(*r, "p", "k", "s") for r in rows]
    random.Random(3).shuffle(full)
    return spark.createDataFrame(full, SCHEMA).repartition(4)


@pytest.mark.parametrize("shard", [trie.SHARD_CHARACTERS, 400, 40])
def test_op13_against_brute_force(workers, shard):  # noqa: F811
    rows = talk(1, 300, ["a", "ab", "", None, "é😀x"]) + [(c, None, "user", "first") for c in (0, 100, 7)]
    rows += [(None, 1, "user", "x"), (600, 1, None, None), (-7, 2, "user", "a"), (-300, 0, "user", "b")]
    rows += [(1000 + i, t, "user", "same") for i in range(60) for t in range(3)]
    assert order(got(frame(workers, rows), shard_characters=shard)) == order(brute(rows))


@pytest.mark.parametrize("shard", [trie.SHARD_CHARACTERS, 2000])
def test_op13_whole_table(workers, shard):  # noqa: F811
    df = workers.read.parquet(f"{SF0001}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert order(got(df, shard_characters=shard)) == order(brute(rows))


def test_op13_odd_rows(workers):  # noqa: F811
    assert got(frame(workers, [])) == []
    assert got(frame(workers, [(None, 1, "user", "x")])) == []
    turnless = [(c, 0, "user", "x") for c in (1, 2, 3, 4, 5)]  # no conversation 0: some lose their only turn
    assert order(got(frame(workers, turnless))) == order(brute(turnless))
    long = [(700, t, "user", f"t{t}") for t in range(3000)] + [(701, t, "user", f"t{t}" * 20_000) for t in range(3)]
    assert order(got(frame(workers, long))) == order(brute(long))
