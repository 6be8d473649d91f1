"""Byte-level BPE encoding by depth-first traversal of a trie of distinct words, and decoding.

With merge rules in the order in which they were learnt, the encoding of a word
is fixed from prefix to prefix: the last token of a prefix is the one suffix
token ``t`` that is compatible with the last token ``u`` of what precedes it,
that is, the merges of ``u`` and ``t`` together leave them apart. So each node of
a trie needs one number, the last token of its prefix, and prefixes that words
share are encoded once. A word's tokens are read off from its end.

Defined cases: NULL counts as empty, an empty text has no ids; special strings
in a text become their special id, as the tokenizers library does by default;
rows are encoded one by one, so repeated ids are fine; an empty table gives no
rows; other columns are ignored. A word of any length costs a bounded number of
steps per byte.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .common import small_batches, table

# fixed value: the pattern that splits text before the merges
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_KNOWN_WORDS = 400_000  # words remembered by a worker process
_KNOWN_PAIRS = 600_000  # neighbouring tokens remembered
_BLOCK_CHARS = 1_000_000
_SLICE = 500  # rows handled together


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of bytes in the vocabulary file: printable Latin-1 is itself, the rest follows 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _edge(token: int, made: dict[int, tuple[int, int, int]], side: int) -> list[tuple[int, int, float]]:
    """The symbols at one edge of a token while it is merged: (symbol, rank that makes it, rank that ends it)."""
    found, until = [], float("inf")
    while token in made:
        found.append((token, made[token][0], until))
        until, token = made[token][0], made[token][side]
    return [*found, (token, -1, until)]


class ByteBpe:
    """Encoder and decoder for a byte-level BPE file of the tokenizers library."""

    def __init__(self, file: str) -> None:
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        stand_in = _byte_of_char()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = {i: s.encode() for s, i in self.special.items()}
        ids = {s: i for s, i in spec["model"]["vocab"].items() if s not in self.special}
        self.bytes_of |= {i: bytes(stand_in[c] for c in s) for s, i in ids.items()}
        self._prepare(ids, spec["model"]["merges"])

    def _prepare(self, ids: dict[str, int], merges: list) -> None:
        self.id_of = {self.bytes_of[i]: i for i in ids.values()}
        self.merges = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[ids[left], ids[right]] = (rank, ids[left + right])
        made = {i: (rank, *pair) for pair, (rank, i) in self.merges.items()}
        self.right_edge = {i: _edge(i, made, 2) for i in ids.values()}
        self.left_edge = {i: _edge(i, made, 1) for i in ids.values()}
        # tokens that the merges of their own bytes reach; no encoding holds another
        self.reached = {s: i for s, i in self.id_of.items() if self._merged(s) == [i]}
        self.prefixes = {s[:n] for s in self.reached for n in range(len(s) + 1)}
        self.suffixes: dict[bytes, tuple] = {}
        self.split = regex.compile(_WORDS).findall
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        self.pairs: dict[int, bool] = {}  # by both ids in one number
        self.known: dict[str, bytes] = {}

    def decode(self, ids: bytes) -> str:
        """The text of little-endian 32-bit ids, special ones included."""
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")

    def _merged(self, text: bytes) -> list[int]:
        """A short text merged step by step."""
        ids = [self.id_of[text[i:i + 1]] for i in range(len(text))]
        while len(ids) > 1:
            best = min(((*self.merges[pair], i) for i, pair in enumerate(zip(ids, ids[1:], strict=False))
                        if pair in self.merges), default=None)
            if best is None:
                break
            ids[best[2]:best[2] + 2] = [best[1]]
        return ids

    def _apart(self, before: int, last: int) -> bool:
        """Whether no merge joins the two tokens; ``before`` -1 stands for the start.

        At any time the symbols at the border are one of each token's edge. They
        join if their merge comes before either is merged into its own token.
        """
        if before < 0:
            return True
        for a, a_from, a_until in self.right_edge[before]:
            for b, b_from, b_until in self.left_edge[last]:
                if a_from < b_until and b_from < a_until:
                    merge = self.merges.get((a, b))
                    # of equal merges the left one comes first
                    if merge and merge[0] < a_until and merge[0] <= b_until:
                        return False
        return True

    def _state(self, suffix: bytes) -> tuple[dict, list[tuple[int, int]], bytes]:
        """What a path ends in: next states by byte, the tokens that are a suffix (longest first), the suffix itself.

        ``suffix`` is the longest one that begins a token, so it contains all of them.
        """
        while suffix not in self.prefixes:
            suffix = suffix[1:]
        if suffix not in self.suffixes:
            ends = (suffix[i:] for i in range(len(suffix)))
            self.suffixes[suffix] = ({}, [(self.reached[s], len(s)) for s in ends if s in self.reached], suffix)
        return self.suffixes[suffix]

    def _encode_words(self, trie: list[bytes]) -> Iterator[bytes]:
        """The ids of words that stand in order.

        Sorted words and the lengths of their common prefixes are a trie in
        depth-first order: going from one word to the next returns to the node
        of the prefix they share and descends along the rest.
        """
        # last[d]: last token of the current path's first d bytes; states[d]: what they end in
        last, states = [-1], [self._state(b"")]
        pairs, bytes_of = self.pairs, self.bytes_of
        path = b""
        for word in trie:
            if len(pairs) > _KNOWN_PAIRS:
                pairs.clear()
            shared = 0
            for a, b in zip(path, word, strict=False):
                if a != b:
                    break
                shared += 1
            del last[shared + 1:], states[shared + 1:]
            state, depth = states[shared], shared
            for byte in word[shared:]:
                following = state[0].get(byte)
                if following is None:
                    following = state[0][byte] = self._state(state[2] + bytes((byte,)))
                state = following
                depth += 1
                for token, size in state[1]:
                    pair = last[depth - size] << 32 | token
                    apart = pairs.get(pair)
                    if apart is None:
                        apart = pairs[pair] = self._apart(last[depth - size], token)
                    if apart:
                        last.append(token)
                        break
                states.append(state)
            path, ids = word, []
            while depth:
                ids.append(last[depth])
                depth -= len(bytes_of[last[depth]])
            ids.reverse()
            yield struct.pack(f"<{len(ids)}I", *ids)

    def _learn(self, words: list[str]) -> None:
        coded = sorted((w.encode(), w) for w in words)
        self.known.update(zip([w for _, w in coded], self._encode_words([b for b, _ in coded]), strict=True))

    def _pieces(self, text: str) -> Iterator[str | bytes]:
        """The words of a text, and special strings as the bytes of their id."""
        at = 0
        for found in self.at_special.finditer(text):
            yield from self.split(text[at:found.start()])
            yield self.special[found[0]].to_bytes(4, "little")
            at = found.end()
        yield from self.split(text[at:])

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= _BLOCK_CHARS:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, texts: list[str]) -> Iterator[bytes]:
        split = [list(self._pieces(t)) if any(s in t for s in self.special) else self.split(t) for t in texts]
        distinct = set(chain.from_iterable(split))
        special = {w for w in distinct if isinstance(w, bytes)}
        new = distinct - self.known.keys() - special
        if len(self.known) + len(new) > _KNOWN_WORDS:
            self.known.clear()
            new = distinct - special
        self._learn(list(new))
        known = self.known
        for words in split:
            if special and not special.isdisjoint(words):
                yield b"".join(w if isinstance(w, bytes) else known[w] for w in words)
            else:
                yield b"".join(map(known.__getitem__, words))


@cache
def _bpe(file: str) -> ByteBpe:
    return ByteBpe(file)


def round_trip(docs: DataFrame, file: str) -> DataFrame:
    """``docs`` with ``ids``, four little-endian bytes each, and the text ``decoded`` from them.

    Columns of these names are replaced. ``file`` must be readable at the same
    path by every executor. One worker encodes and decodes a few rows at a time,
    so its memory does not depend on the size of Spark's batches.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("ids", "decoded")
    schema = StructType([*docs.schema, StructField("ids", BinaryType()), StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(file)
        for batch in (b.slice(at, _SLICE) for b in batches for at in range(0, b.num_rows, _SLICE)):
            ids = list(bpe.encode([t or "" for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.binary()), pa.array(map(bpe.decode, ids), pa.string())],
                names=schema.fieldNames())
        # the next task of this worker may be another operator's
        bpe.known.clear()
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, schema)


def digest(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole document under byte_bpe_50k, and the text decoded from them."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")))
