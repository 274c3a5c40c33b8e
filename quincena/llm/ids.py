"""Token ids of whole texts by a ``tokenizers`` file.

A plain byte-level BPE is a table of ranks, and ``tiktoken`` encodes by ranks
several times faster and without remembering anything. That gives the same ids
exactly when every token, merged on its own by ranks, last joins the pair that
the file lists for it: two neighbours whose bytes make up a token are then
always that pair, since nothing outside them has touched either. ``merge_ranks``
checks this token by token; any other file goes to the ``tokenizers`` library."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from quincena.llm.common import kept
from quincena.llm.counts import library_tokenizer

# Fixed value: the split pattern of byte-level pre-tokenizers.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of_character() -> dict[str, int]:
    """How byte-level files write bytes: printable Latin-1 characters stand for
    themselves, the others for the characters from U+0100 on, in order."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def _is_plain(spec: dict) -> bool:
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    return (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
            and not spec.get("normalizer") and not spec.get("post_processor") and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                               "byte_fallback", "ignore_merges"))
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec.get("added_tokens", [])))


def _last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, ...]:
    """What is left of a token before the merge that makes it."""
    parts = [token[i:i + 1] for i in range(len(token))]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == 1 << 40:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return tuple(parts)


@lru_cache(4)
def merge_ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]] | None:
    """Ranks and special tokens of a file that ranks say everything about, else None."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if not _is_plain(spec):
        return None
    byte = byte_of_character()
    try:
        ranks = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = [tuple(bytes(byte[c] for c in part) for part in m) for m in merges]
    except KeyError:
        return None
    made = [ranks.get(a + b) for a, b in pairs]
    if None in made or made != sorted(set(made)) or len(made) + 256 != len(ranks) or any(bytes([b]) not in ranks for b in range(256)):
        return None
    if any(_last_pair(a + b, ranks) != (a, b) for a, b in pairs):
        return None
    return ranks, {t["content"]: t["id"] for t in spec.get("added_tokens", [])}


def _encoder(path: str, by_ranks: bool):
    if not by_ranks:
        tokenizer = library_tokenizer(path)
        return lambda texts: [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    import tiktoken

    ranks, special = _ranks(path)
    encoding = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return lambda texts: [encoding.encode_to_numpy(t, allowed_special="all") for t in texts]


def _ranks(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """As ``merge_ranks``, for a file that has been found fit."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte = byte_of_character()
    return ({bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()},
            {t["content"]: t["id"] for t in spec.get("added_tokens", [])})


def id_encoder(path: str, by_ranks: bool):
    """texts -> unsigned 32-bit arrays of ids; one per worker process, kept
    across tasks. ``by_ranks``: whether ``merge_ranks`` has found the file fit."""
    return kept(("ids", path), lambda: _encoder(path, by_ranks))
