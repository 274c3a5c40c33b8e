"""Byte-level BPE as a finite-state transducer.

A tokenisation is the one that rank-ordered merging gives if and only if each
two neighbouring tokens, merged on their own, stay the two tokens they are.
That makes encoding a path through a nondeterministic machine whose states
are (last token, bytes of the unfinished token): bytes walk a trie of the
vocabulary, and at a trie node that is a token the path may close it if it
goes with the token before. For any prefix exactly one path is closed at its
end. ``Transducer`` determinises this machine as texts need it: a state is
the set of live paths with the tokens not yet sent, and whatever all live
paths agree on is sent, after a lookahead bounded by the longest chain of
tokens that a longer token can still overturn. States and transitions are
kept up to a limit and then built anew.

``Decoder`` is the way back: token ids in any portions to text, by a state
machine that holds back the bytes of an unfinished UTF-8 character.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.llm.chunks import Remembered
from quincena.llm.common import arrow_slices, bounded, kept

MAX_STATES = 600_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank from a file of lines ``base64 rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks, self.max_states = ranks, max_states
        self.token = {rank: token for token, rank in ranks.items()}
        self.split = lru_cache(None)(self._split)  # at most one entry for each token
        self._build_trie()
        self._reset()

    def _build_trie(self) -> None:
        """Nodes are numbered from the root, 0; ``child[node << 8 | byte]``,
        ``rank_at[node]`` (-1: no token) and ``inner[node]`` (it has children)."""
        self.child: dict[int, int] = {}
        self.rank_at, self.inner = [-1], bytearray(1)
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                self.inner[node] = 1
                below = self.child.get(node << 8 | byte)
                if below is None:
                    below = self.child[node << 8 | byte] = len(self.rank_at)
                    self.rank_at.append(-1)
                    self.inner.append(0)
                node = below
            self.rank_at[node] = rank

    def _reset(self) -> None:
        """State 0: nothing read, one path, closed, nothing pending. A path is
        (last token, trie node of the unfinished one, tokens not yet sent)."""
        self.known_pairs: dict[tuple[int, int], bool] = {}
        self.states: list[tuple] = [((-1, 0, ()),)]
        self.number = {self.states[0]: 0}
        self.next: dict[int, tuple[int, tuple[int, ...]]] = {}

    def merge(self, piece: bytes, last: bool = True) -> list[bytes]:
        """The definition: always merge the pair of lowest rank, leftmost
        first (without the ``last`` merge: down to two parts)."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 2 - last:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[best] + parts[best + 1] not in self.ranks:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def _split(self, token: bytes) -> tuple[bytes, bytes]:
        """The two parts whose merge, the last one, makes ``token``."""
        parts = self.merge(token, last=False)
        return parts[0], parts[1]

    def _fits(self, before: int, token: bytes) -> bool:
        """May ``token`` follow the token ``before`` (-1: nothing)?

        Seen backwards in time, the later made of the two tokens that meet at
        the border falls back into its parts, until both are bytes. They stay
        apart unless, while two such parts stood at the border, merging them
        came before the merge that took one of them away (of equal ranks the
        left one comes first)."""
        if before < 0:
            return self.merge(token) == [token]
        rank = self.ranks.get
        x, y = self.token[before], token
        x_gone = y_gone = 1 << 40
        while True:
            across = rank(x + y, 1 << 40)
            if across < x_gone and across <= y_gone and across < 1 << 40:
                return False
            x_made, y_made = (rank(t) if len(t) > 1 else -1 for t in (x, y))
            if x_made < 0 and y_made < 0:
                return True
            if y_made >= x_made:
                y, y_gone = self.split(y)[0], y_made
            else:
                x, x_gone = self.split(x)[1], x_made

    def _state(self, paths: tuple) -> int:
        number = self.number.setdefault(paths, len(self.states))
        if number == len(self.states):
            self.states.append(paths)
        return number

    def _step(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state after ``byte``, and the tokens that are now certain."""
        child, rank_at, inner, pairs = self.child, self.rank_at, self.inner, self.known_pairs
        live, closed = [], None
        for last, node, pending in self.states[state]:
            node = child.get(node << 8 | byte)
            if node is None:
                continue
            rank = rank_at[node]
            if rank >= 0 and closed is None:
                fits = pairs.get((last, rank))
                if fits is None:
                    fits = pairs[last, rank] = self._fits(last, self.token[rank])
                if fits:
                    closed = (rank, 0, (*pending, rank))
            if inner[node]:
                live.append((last, node, pending))
        if closed is None:
            raise ValueError("the vocabulary lacks a byte")
        live.append(closed)  # always the last path of a state
        sure = 0
        first = live[0][2]
        for token in first:
            if not all(len(p) > sure and p[sure] == token for _, _, p in live):
                break
            sure += 1
        if sure:
            live = [(last, node, p[sure:]) for last, node, p in live]
        return self._state(tuple(live)), first[:sure]

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one piece (one match of the split pattern)."""
        if len(self.states) > self.max_states:
            self._reset()
        state, out, following = 0, [], self.next.get
        for byte in piece:
            known = following(state << 8 | byte)
            if known is None:
                if len(self.states) > 2 * self.max_states:  # within one long piece
                    here = self.states[state]
                    self._reset()
                    state, following = self._state(here), self.next.get
                known = self.next[state << 8 | byte] = self._step(state, byte)
            state, sure = known
            if sure:
                out += sure
        out += self.states[state][-1][2]
        return out


# Bytes that follow a UTF-8 lead byte.
_FOLLOW = bytes(0 if b < 0xC2 else 1 if b < 0xE0 else 2 if b < 0xF0 else 3 if b < 0xF5 else 0 for b in range(256))


class Decoder:
    """Ids to text in portions. The state between portions is the (at most
    three) bytes of a character that has begun; what is no UTF-8 comes out as
    U+FFFD, as from decoding all bytes at once."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.held = tokens, b""

    def feed(self, ids) -> str:
        data = self.held + b"".join(map(self.tokens.__getitem__, ids))
        end = len(data)
        for back in range(1, min(3, end) + 1):
            lead = data[-back]
            if lead >= 0xC0:
                if _FOLLOW[lead] >= back and self._may_begin(data[-back:]):
                    end -= back
                break
            if lead < 0x80:
                break
        self.held = data[end:]
        return data[:end].decode("utf-8", "replace")

    @staticmethod
    def _may_begin(part: bytes) -> bool:
        """Can a character still come of these bytes? Lead bytes E0, ED, F0
        and F4 bound the byte behind them."""
        if len(part) < 2:
            return True
        low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(
            part[0], (0x80, 0xBF))
        return low <= part[1] <= high

    def finish(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


class Encoder:
    """Whole texts to ids: split pattern, transducer, remembered chunks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.machine = Transducer(ranks)
        self.find = regex.compile(pattern).findall
        self.memory = Remembered(self._chunks)

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        """Encodings of unknown chunks. A piece with its leading space may be
        a chunk that is known (the word without what follows it here)."""
        find, encode, out = self.find, self.machine.encode, []
        known, older = self.memory.memo.get, self.memory.older.get
        for chunk in chunks:
            pieces = find(chunk)
            if len(pieces) == 1:
                out.append(array("I", encode(pieces[0].encode())).tobytes())
                continue
            parts = []
            for piece in pieces:
                part = (known(piece[1:]) or older(piece[1:])) if piece[0] == " " else None
                parts.append(part or array("I", encode(piece.encode())).tobytes())
            out.append(b"".join(parts))
        return out

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        return [b"".join(parts) for parts in self.memory.look_up(texts)]


def encoder(path: str, pattern: str) -> Encoder:
    """One per worker process, kept across tasks."""
    return kept(("bpe", path, pattern), lambda: Encoder(read_ranks(path), pattern))


def encode(docs: DataFrame, rank_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text",
           with_text: bool = False) -> DataFrame:
    """Token ids of every text (null: empty, no ids) and the text decoded from them.

    Columns: the id, ``ids`` (binary: little-endian unsigned 32-bit integers),
    ``decoded_sha256`` (hex, of the decoded text's UTF-8 bytes), and with
    ``with_text`` the ``decoded`` text. One row per input row, repeated and
    null ids included; other columns are left out. An empty table gives an
    empty one. Nothing is shuffled; tables live in the worker process.
    """
    decoded = ", decoded string" if with_text else ""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        import numpy as np

        codec = encoder(rank_path, pattern)
        tokens = codec.machine.token
        for part in arrow_slices(batches, "text"):
            ids = codec.encode_many(part.column("text").to_pylist())
            texts = []
            for b in ids:
                d, array, out = Decoder(tokens), np.frombuffer(b, "<u4"), []
                for at in range(0, len(array), 1 << 16):
                    out.append(d.feed(array[at:at + (1 << 16)].tolist()))
                texts.append("".join(out) + d.finish())
            digests = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(digests, pa.string())]
                + [pa.array(texts, pa.string())] * with_text,
                names=["doc_id", "ids", "decoded_sha256"] + ["decoded"] * with_text)

    return bounded(rows).mapInArrow(run, f"doc_id {kind}, ids binary, decoded_sha256 string{decoded}")


def digest(encoded: DataFrame) -> DataFrame:
    """``encode``'s result as counts and hashes."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), "decoded_sha256")
