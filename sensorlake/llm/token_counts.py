"""Token counts under a piece vocabulary, by rank-synchronous merging of ragged arrays.

The merge rules of a sentencepiece BPE model are its pieces: of all adjacent
symbols whose concatenation is a piece, the best-scored is merged first, the
leftmost of equals. No piece continues after a white space mark or holds a
line feed (checked when the model is loaded), so a text falls into pre-tokens
that merge apart. The distinct new pre-tokens of a batch stand one after the
other in one flat array; each round merges, in every sequence at once, all pairs
of its lowest rank. Surviving symbols are counted: one for a piece, one per UTF-8
byte for a character without a piece.

A sequence is first a pre-token. Where two neighbouring symbols together occur in
no piece, nothing will ever be merged across them, and the sequence is cut there;
so a word of a million characters soon falls into short sequences that advance
on their own, and rounds do not grow with its length. Where a merge opens a pair
of lower rank, that one comes before other pairs of the old rank which it could
reach: those in its reach, or in a run of overlapping pairs, wait for a later round.

Defined cases: NULL counts as empty, an empty text has no tokens; rows are
counted one by one, so repeated ids are fine; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import no_null, table

SPACE = "▁"
_NO_RANK = np.iinfo(np.int32).max
_KNOWN_WORDS = 250_000  # pre-tokens remembered by a worker process
_BLOCK_CHARS = 1_000_000  # characters merged together


class PieceCounter:
    """Counts tokens as the library does for a BPE model with byte fallback."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [i for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        scored = sorted(pieces, key=model.get_score, reverse=True)
        rank_of = {model.id_to_piece(i): rank for rank, i in enumerate(scored)}
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or "\n" in p for p in rank_of):
            raise ValueError("pieces run across words: pre-tokens would not merge apart")
        # symbols: pieces by rank, then other characters that occur in pieces
        self.symbols = list(rank_of) + sorted({c for p in rank_of for c in p} - rank_of.keys())
        number = {s: n for n, s in enumerate(self.symbols)}
        self.cost = np.array([1 if s in rank_of else len(s.encode()) for s in self.symbols])
        n = self.n = len(self.symbols) + 1  # the last number stands for any other character
        self.char = np.full(0x110000, n - 1, np.int32)
        for char, code in number.items():
            if len(char) == 1:
                self.char[ord(char)] = code
        # neighbours that occur in a piece; those that are a piece have its rank
        ranks = {}
        for piece in rank_of:
            for middle in range(1, len(piece)):
                lefts = [number[piece[i:middle]] for i in range(middle) if piece[i:middle] in number]
                rights = [number[piece[middle:i]] for i in range(middle + 1, len(piece) + 1) if piece[middle:i] in number]
                ranks.update((left * n + right, _NO_RANK) for left in lefts for right in rights)
        for piece, rank in rank_of.items():
            for cut in range(1, len(piece)):
                left, right = number.get(piece[:cut]), number.get(piece[cut:])
                if left is not None and right is not None:
                    ranks[left * n + right] = rank
        self.keys = np.array(sorted(ranks), np.int64)
        self.ranks = np.array([ranks[k] for k in sorted(ranks)], np.int32)
        self.reach = 2 * max(map(len, rank_of))
        self.known: dict[str, int] = {}

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, and whether any piece holds it."""
        key = left.astype(np.int64) * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        held = self.keys[at] == key
        return np.where(held, self.ranks[at], _NO_RANK), held

    def _merge(self, words: list[str]) -> np.ndarray:
        """Tokens of each word; all sequences are merged in step."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        symbol = self.char[code]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        # a character without a number never merges and counts its bytes
        other = symbol == self.n - 1
        width = 1 + (code[other] >= 0x80).astype(np.int64) + (code[other] >= 0x800) + (code[other] >= 0x10000)
        total = np.zeros(len(words)) + np.bincount(word[other], width, len(words))
        cost = np.append(self.cost, 0)
        rank = np.full(len(symbol), _NO_RANK, np.int32)  # of the pair that starts here
        opens = np.ones(len(symbol), bool)  # whether a sequence starts here
        changed = np.flatnonzero(word[:-1] == word[1:])
        while len(symbol):
            rank[changed], held = self._rank(symbol[changed], symbol[changed + 1])
            opens[changed + 1] = ~held
            starts = np.flatnonzero(opens)
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(symbol)))
            each = np.repeat(lowest, sizes)
            ended = each == _NO_RANK
            total += np.bincount(word[ended], cost[symbol[ended]], len(words)) if ended.any() else 0
            at = np.flatnonzero((rank == each) & ~ended)
            at = at[self._chosen(symbol, opens, rank, at)]
            symbol[at] = rank[at]
            keep = ~ended
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbol, word, rank, opens = symbol[keep], word[keep], rank[keep], opens[keep]
            at = place[at]
            rank[at] = _NO_RANK
            # pairs with a new symbol, inside their sequence
            renewed = np.zeros(len(symbol) + 1, bool)
            renewed[at] = True
            renewed[at[~opens[at]] - 1] = True
            changed = np.flatnonzero(renewed[:len(symbol) - 1] & ~opens[1:]) if len(symbol) else at
        return total.astype(np.int64)

    def _chosen(self, symbol: np.ndarray, opens: np.ndarray, rank: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Which of the lowest pairs, those that start ``at``, are merged in this round."""
        if not len(at):
            return np.zeros(0, bool)
        # of overlapping pairs every other one, from the left
        fresh = np.concatenate([[True], np.diff(at) > 1])
        run = np.cumsum(fresh)
        chosen = (at - np.maximum.accumulate(np.where(fresh, at, 0))) % 2 == 0
        own = rank[at]
        merges = np.zeros(len(symbol), bool)
        merges[at[chosen]] = True
        before, behind = np.maximum(at - 1, 0), np.minimum(at + 2, len(symbol) - 1)
        inner, outer = ~opens[at], (at + 2 < len(symbol)) & ~opens[behind]
        lower = np.zeros(len(at), bool)
        # its neighbour is as it is, or what an adjacent merge makes of it
        for here, beside, merged in ((inner, before, (at > 1) & merges[at - 2]), (outer, behind, merges[behind])):
            on = np.flatnonzero(here & chosen)
            for other in (symbol[beside[on]], np.where(merged[on], own[on], symbol[beside[on]])):
                left, right = (other, own[on]) if beside is before else (own[on], other)
                lower[on] |= self._rank(left, right)[0] < own[on]
        if not lower.any():
            return chosen
        # what a merge that opens a lower rank could reach waits
        place = np.arange(len(at))
        last = np.maximum.accumulate(np.where(lower, place, -1))
        last = np.concatenate([[-1], last[:-1]])
        sequence = np.cumsum(opens)[at]
        waits = (last >= 0) & (sequence[last] == sequence) & ((at - at[last] <= self.reach) | (run[last] == run))
        # a run waits as a whole behind its first one
        return chosen & ~waits


    def _learn(self, words: set[str]) -> None:
        block, size = [], 0
        for w in words:
            block.append(w)
            size += len(w)
            if size >= _BLOCK_CHARS:
                self.known.update(zip(block, self._merge(block).tolist(), strict=True))
                block, size = [], 0
        self.known.update(zip(block, self._merge(block).tolist(), strict=True))

    def count(self, texts: list[str]) -> list[int]:
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= _BLOCK_CHARS:
                out += self._count(group)
                group, size = [], 0
        return out + self._count(group)

    def _count(self, texts: list[str]) -> list[int]:
        split = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n").findall
        texts = [split(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        distinct = set(chain.from_iterable(texts))
        new = distinct - self.known.keys()
        if len(self.known) + len(new) > _KNOWN_WORDS:
            self.known.clear()
            new = distinct
        self._learn(new)
        known = self.known
        return [sum(map(known.__getitem__, words)) for words in texts]


@cache
def _counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)


def token_count(text: Column, model_file: str) -> Column:
    """Tokens of a text; ``model_file`` must be readable at the same path by every executor."""
    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(model_file)
        for batch in texts:
            yield pd.Series(counter.count(batch.tolist()), dtype="int64")

    return count(no_null(text))


def op3_token_counts(spark: SparkSession, sf_dir: str, limit: int = 4096) -> DataFrame:
    """Tokens of every whole document under piece_bpe_32k."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", F.octet_length(no_null(F.col("text"))).cast("long").alias("n_bytes"),
        token_count(F.col("text"), public_tokenizers.path("piece_bpe_32k.model")).alias("n_tokens"),
    ).withColumn("over_limit", F.col("n_tokens") > limit)
