"""Chat formatting with a loss mask that is aligned by offsets.

A conversation is rendered as one text: for every turn a mark, the escaped
role, a mark, the escaped text, and a mark at the end. The mark is the
vocabulary's special string, which always is a token of its own, so no token
crosses a border. The whole text is encoded once, with offsets; the sorted
spans of the assistant's turns and the sorted spans of the tokens are
intersected by binary search, which gives the loss mask over tokens.

Escaping puts a backslash before every backslash and into every ``<|``. What
follows a backslash stands for itself, so it is reversible, and no mark can
appear inside a text.

Defined cases: turns are ordered by turn, then role, then text, so ties and
repeated rows have a fixed place and are kept; NULL text or role is empty; NULL
conversation ids form one conversation; an empty table gives no rows; other
columns are ignored. A conversation is one record of the output and must fit
into one row, like the text that is made of it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import no_null, table

MARK = "<|endoftext|>"
_SCHEMA = "conv_id bigint, formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>"
_BATCH = 64


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = MARK + escape(role) + MARK, escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body]
        at += len(head) + len(body)
    return "".join([*parts, MARK]), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    fields = [unescape(f) for f in formatted.split(MARK)[1:-1]]
    return list(zip(fields[::2], fields[1::2], strict=True))


def loss_mask(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which tokens overlap a span; spans and tokens stand in order."""
    if not spans:
        return np.zeros(len(starts), bool)
    first, last = np.array(spans).T
    span = np.minimum(np.searchsorted(last, starts, side="right"), len(spans) - 1)  # the first that ends behind
    return (starts < last[span]) & (ends > first[span])


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, loss: np.ndarray) -> str:
    """The text under the mask, unescaped. Tokens that share a character have the same offsets."""
    found, upto = [], 0
    for start, end in zip(starts[loss].tolist(), ends[loss].tolist(), strict=True):
        if end > upto:
            found.append(formatted[max(start, upto):end])
            upto = end
    return unescape("".join(found))


@cache
def _tokenizer(file: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encoded(conv_ids: list, conversations: list[list[tuple[str, str]]], file: str) -> pa.RecordBatch:
    texts, spans = zip(*map(render, conversations), strict=True)
    ids, starts, ends, loss = [], [], [], []
    for found, own in zip(_tokenizer(file).encode_batch(list(texts), add_special_tokens=False), spans, strict=True):
        offsets = np.array(found.offsets, np.int32).reshape(-1, 2)
        ids.append(found.ids)
        starts.append(offsets[:, 0])
        ends.append(offsets[:, 1])
        loss.append(loss_mask(own, offsets[:, 0], offsets[:, 1]))
    ints = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(conv_ids, pa.int64()), pa.array(texts, pa.string()), pa.array(ids, ints), pa.array(starts, ints),
         pa.array(ends, ints), pa.array(loss, pa.list_(pa.bool_()))],
        names=["conv_id", "formatted", "ids", "starts", "ends", "loss"])


def format_conversations(conversations: DataFrame, file: str) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): text, ids, offsets and loss mask."""
    turn = F.struct("turn", no_null(F.col("role")).alias("role"), no_null(F.col("text")).alias("text"))
    gathered = conversations.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(
        F.array_sort(F.collect_list(turn)).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                turns = [[(t["role"], t["text"]) for t in c] for c in part.column("turns").to_pylist()]
                yield _encoded(part.column("conv_id").to_pylist(), turns, file)

    return gathered.mapInArrow(run, _SCHEMA)


_DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint")


def digest(formatted: DataFrame) -> DataFrame:
    """Figures read back from the formatted text, the offsets and the mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                text = batch.column("formatted")[i].as_py()
                starts, ends, loss = (
                    batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("starts", "ends", "loss"))
                turns = parse(text)
                learnt = masked_text(text, starts, ends, loss)
                rows.append((
                    batch.column("conv_id")[i].as_py(), len(turns),
                    hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                    len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
            columns = list(zip(*rows, strict=True))
            names = [c.split()[0] for c in _DIGEST.split(", ")]
            types = [pa.string() if c.endswith("string") else pa.int64() for c in _DIGEST.split(", ")]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return formatted.mapInArrow(run, _DIGEST)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe -7, formatted, encoded and read back."""
    import public_tokenizers

    said = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return digest(format_conversations(rows, public_tokenizers.path("byte_bpe_50k.json")))


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
),
escaped AS (
  SELECT *, replace(replace(text, '\', '\\'), '<|', '<\|') AS body,
         replace(replace(role, '\', '\\'), '<|', '<\|') AS head FROM rows
),
gathered AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS learnt,
         sum(length(body) + length(head) + 2 * 13) + 13 AS formatted_chars
  FROM escaped GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(learnt) AS BIGINT) AS loss_chars,
       sha256(learnt) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM gathered
"""
