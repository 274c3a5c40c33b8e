"""op1, op3, op8: token work against the libraries."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import corpus, frame, workers  # noqa: F401

from quincena.llm import bpe, chunks, counts, packing

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [(100, "a <|endoftext|> b"), (101, "two  blanks\n x \n\n y "), (102, " lead"), (103, "it's  'll \t'd 12 3"), (None, "no id"),
       (100, "a <|endoftext|> b")]


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.encoder(RANKS, public_tokenizers.PATTERN)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("abetniosr ABE'sdl\n\t 019.,-éñß中😀 \x1c"), max_size=80))
def test_chunks_never_cross_tokens(text):
    first, rest = chunks.chunks(text)
    assert first + "".join(" " + c for c in rest) == text
    library = counts.library_tokenizer(JSON)
    whole = library.encode(text, add_special_tokens=False).ids
    apart = [i for part in [first, *(" " + c for c in rest)] for i in library.encode(part, add_special_tokens=False).ids]
    assert apart == whole


def test_transducer_is_merging(reference, codec):
    rng = random.Random(5)
    for _ in range(1500):
        alphabet = rng.choice(["ab", "aeionrst ", " \n\tab'", "éàü中文😀a ", "01.,!?<|endoftext|>", "=-_*#"])
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120)))
        assert np.frombuffer(codec.encode_many([text])[0], "<u4").tolist() == reference.encode_ordinary(text)


def test_transducer_forgets_and_goes_on(reference):
    machine = bpe.Transducer(bpe.read_ranks(RANKS), max_states=50)
    rng = random.Random(2)
    for n in (10, 400, 5000):
        piece = "".join(rng.choice("abcdefgh") for _ in range(n))
        assert machine.encode(piece.encode()) == reference.encode_ordinary(piece)
        assert len(machine.states) <= 102


def test_decoder_in_portions_is_decoding_at_once(codec):
    rng = random.Random(3)
    single = {i: t for i, t in codec.machine.token.items() if len(t) == 1}
    for _ in range(600):
        data = bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE4, 0xB8, 0xAD, 0xF0, 0x9F, 0x98, 0x80, 0xE0, 0xED, 0xF4, 0xC1, 0xFF])
                     for _ in range(rng.randint(0, 12)))
        ids = [next(i for i, t in single.items() if t == bytes((b,))) for b in data]
        d = bpe.Decoder(codec.machine.token)
        assert "".join(d.feed([i]) for i in ids) + d.finish() == data.decode("utf-8", "replace")


def test_op3_rows(workers, reference):  # noqa: F811
    rows = corpus() + ODD
    got = bpe.digest(bpe.encode(frame(workers, rows), RANKS, public_tokenizers.PATTERN)).collect()
    expected = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        expected.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert bpe.encode(frame(workers, []), RANKS, public_tokenizers.PATTERN, with_text=True).collect() == []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_op8_counts(workers, name):  # noqa: F811
    path = public_tokenizers.path(name)
    rows = [r for r in corpus() + ODD if not (name.endswith(".model") and len(r[1] or "") > 100_000)]
    if name.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        count = lambda t: len(counts.library_tokenizer(path).encode(t, add_special_tokens=False).ids)
    got = counts.count_tokens(frame(workers, rows), path, limit=50).collect()
    expected = [(i, len((t or "").encode()), count(t or ""), count(t or "") > 50) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    assert counts.count_tokens(frame(workers, []), path).collect() == []


def brute_first_fit(sizes, capacity):
    bins, out = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        b = next((k for k, used in enumerate(bins) if used + sizes[i] <= capacity), len(bins))
        if b == len(bins):
            bins.append(0)
        out[i] = (b, bins[b])
        bins[b] += sizes[i]
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_tournament_is_first_fit_decreasing(sizes):
    assert packing.first_fit_decreasing(sizes, 64) == brute_first_fit(sizes, 64)


def test_op1_rows(workers):  # noqa: F811
    rows = corpus() + [(200 + i, "short text " * (i % 30)) for i in range(300)]
    got = packing.pack_documents(frame(workers, rows), JSON, with_ids=True).collect()
    library = counts.library_tokenizer(JSON)
    by, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(by) == {i for i, _ in rows}
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by[i], key=lambda r: r.start):
            piece = struct.pack(f"<{r.length}I", *ids[at:at + r.length])
            assert (r.start, r.doc_tokens, r.ids_crc32, bytes(r.ids)) == (at, len(ids), zlib.crc32(piece), piece)
            at += r.length
        assert at == len(ids)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    total = sum(r.length for r in got)
    assert len(sequences) <= total / 1024 * 1.02 + 2
    assert packing.pack_documents(frame(workers, []), JSON).collect() == []


def test_op1_repeated_rows_are_documents_of_their_own(workers):  # noqa: F811
    got = packing.pack_documents(frame(workers, [(1, "a b"), (1, "a b"), (None, "c")]), JSON).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3


def test_op1_ids_by_ranks_are_the_library_s():
    import numpy as np

    from quincena.llm import ids
    from quincena.llm.counts import library_tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    assert ids.merge_ranks(path) is not None
    assert ids.merge_ranks(public_tokenizers.path("word_bpe_49k.json")) is None
    rng = random.Random(4)
    texts = ["", " ", "a<|endoftext|>b <|endoftext|> <|endof", "\n\n  x\t\ty  ", "don't we'll 'S", "a" * 5000, " " * 3000 + "é😀",
             "١٢٣ 一二三 \u0301a\u200d", "\x00\x1f\x85\u2028z"]
    texts += ["".join(rng.choice("abcdeé 一\n.'1😀 ") for _ in range(rng.randrange(200))) for _ in range(500)]
    want = [e.ids for e in library_tokenizer(path).encode_batch_fast(texts, add_special_tokens=False)]
    for by_ranks in (True, False):
        got = ids._encoder(path, by_ranks)(texts)
        assert [g.tolist() for g in got] == want and all(g.dtype == np.uint32 for g in got)


def test_op1_a_file_whose_merges_ranks_do_not_tell(tmp_path):
    import json

    from quincena.llm import ids

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = json.load(f)
    made = {c: i for c, i in spec["model"]["vocab"].items() if i < 256}
    for merges, fit in (([["b", "c"], ["a", "bc"]], True), ([["a", "b"], ["b", "c"], ["a", "bc"]], False)):
        spec["model"]["merges"] = merges
        spec["model"]["vocab"] = made | {a + b: 256 + i for i, (a, b) in enumerate(merges)}
        path = tmp_path / f"{len(merges)}.json"
        path.write_text(json.dumps(spec), encoding="utf-8")
        assert (ids.merge_ranks(str(path)) is not None) == fit


def test_op1_copies_spread_over_groups(workers):  # noqa: F811
    docs = frame(workers, [(None, None)] * 3000)
    got = packing.pack(packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json")), 3000, group_documents=600)
    sizes = [r["count"] for r in got.groupBy((got.sequence_id / (1 << 32)).cast("int")).count().collect()]
    assert len(sizes) == 5 and max(sizes) < 900
