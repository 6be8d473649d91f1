"""URL verdicts from a sorted array of 64-bit digests that tasks map into memory.

Entries are a host and a path prefix. An entry fits its host and all subdomains
if the URL's path begins with the entry's. Entries are either rules, of which
the longest decides, or listed hosts, which block where no rule fits.

Tasks sort the entries by the xxhash of host and path, in parts of about
``PART_BYTES``: digests, verdicts, offsets and the full strings. The parts lie
in the shared folder and reach every executor once, as files beside the job,
where they are mapped into memory: what a worker needs of them is in the page
cache and shared by all workers of a machine. For a URL all suffixes of its host
that are not longer than the longest listed host, with all prefixes of its path
that have the length of a listed path, are looked up together by binary search;
a digest that is found counts only if the stored string is the same.

Bounds: a list takes its strings and 17 bytes an entry of every executor's disk,
``MAX_LIST_BYTES`` at most, else an error; a longer one can be judged in pieces,
since the longest rule of all pieces decides. Nothing of it is held whole in a
process.

Defined cases: a NULL url, or one without ``://``, has an empty host and path,
fits no entry and is allowed; an entry without host fits nothing; of equal
entries, rules come before listed hosts and "block" before "allow"; of rules of equal
length the one with the longer host counts; rows come back as often as they come
in, NULL ids too; an empty list allows all, an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import mmap
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, no_null, small_batches, table

PART_BYTES = 16 << 20
MAX_LIST_BYTES = 16 << 30
_SEED = 42  # of the JVM's xxhash64
_BLOCK, _RULE = 1, 2  # bits of an entry's value
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    return F.translate(F.regexp_extract(no_null(url), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(no_null(url), _PARTS, 2)


def digests_of(keys: list[bytes]) -> np.ndarray:
    """The digests of the JVM's xxhash64."""
    return np.array([xxhash.xxh64_intdigest(k, _SEED) for k in keys], np.uint64).view(np.int64)


def _part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The file of one part: count, digests, values, offsets, strings."""
    keys, values = [], []
    for batch in batches:
        keys += [k.encode() for k in batch.column("key").to_pylist()]
        values += batch.column("value").to_pylist()
    if not keys:
        return
    digests = digests_of(keys)
    order = np.argsort(digests, kind="stable")
    offsets = np.concatenate([[0], np.cumsum([len(keys[i]) for i in order])]).astype(np.int64)
    whole = b"".join([
        np.int64(len(keys)).tobytes(), digests[order].tobytes(), offsets.tobytes(), np.array(values, np.int8)[order].tobytes(),
        *(keys[i] for i in order)])
    yield pa.RecordBatch.from_arrays([pa.array([int(digests.min())]), pa.array([whole], pa.binary())], names=["least", "part"])


class DigestArray:
    """The parts of a list, mapped into memory, in the order of their digests."""

    def __init__(self, paths: Sequence[str]):
        self.parts = []
        for path in paths:
            with open(path, "rb") as file:
                whole = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
            n = int(np.frombuffer(whole, np.int64, 1)[0])
            digests = np.frombuffer(whole, np.int64, n, 8)
            offsets = np.frombuffer(whole, np.int64, n + 1, 8 + 8 * n)
            values = np.frombuffer(whole, np.int8, n, 16 + 16 * n)
            self.parts.append((whole, digests, offsets, values, 16 + 17 * n))
        self.begins = np.array([p[1][0] for p in self.parts], np.int64)

    def look_up(self, keys: list[bytes]) -> np.ndarray:
        """The value of every key, 0 for those that are not in the list."""
        found = np.zeros(len(keys), np.int8)
        wanted = digests_of(keys)
        own = np.searchsorted(self.begins, wanted, "right") - 1
        for p, (whole, digests, offsets, values, strings) in enumerate(self.parts):
            mine = np.flatnonzero(own == p)
            at = np.searchsorted(digests, wanted[mine])
            # the digests are sorted, so equal ones of other strings stand next to each other
            while len(mine):
                inside = at < len(digests)
                inside[inside] = digests[at[inside]] == wanted[mine[inside]]
                mine, at = mine[inside], at[inside]
                begin, end = offsets[at] + strings, offsets[at + 1] + strings
                same = np.fromiter((whole[b:e] == keys[i] for i, b, e in zip(mine, begin, end, strict=True)), bool, len(mine))
                found[mine[same]] = values[at[same]]
                mine, at = mine[~same], at[~same] + 1
        return found


def _write(spark: SparkSession, path: str, whole: bytes) -> None:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(whole))
    finally:
        out.close()


def distribute(entries: DataFrame) -> tuple[list[str], int, list[int]]:
    """Names of the files that hold ``entries`` (host, path, value), the longest host and all lengths of paths."""
    spark = entries.sparkSession
    small_batches(spark)
    key = F.concat("host", "path")
    entries = entries.where(F.col("host") != "").groupBy("host", "path").agg(F.max("value").alias("value"))
    size, host, lengths = entries.agg(
        F.coalesce(F.sum(F.octet_length(key) + 17), F.lit(0)), F.coalesce(F.max(F.length("host")), F.lit(0)),
        F.sort_array(F.collect_set(F.length("path")))).first()
    if size > MAX_LIST_BYTES:
        raise ValueError(f"the list takes {size} bytes of every executor's disk, more than {MAX_LIST_BYTES}; judge it in pieces")
    # equal digests stay in one part
    parts = entries.select(key.alias("key"), "value").repartitionByRange(
        -(-size // PART_BYTES) or 1, F.xxhash64("key")).mapInArrow(_part, "least bigint, part binary")
    folder, found = new_path(spark, "urls"), []
    for row in parts.toLocalIterator():
        name = f"urls-{uuid.uuid4().hex}"
        _write(spark, f"{folder}/{name}", row["part"])
        spark.sparkContext.addFile(f"{folder}/{name}")
        found.append((row["least"], name))
    return [name for _, name in sorted(found)], host, lengths


_FOUND = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
                    ("verdict", pa.string())])


def _judge(names: list[str], longest_host: int, path_lengths: list[int]):
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = DigestArray([SparkFiles.get(name) for name in names])
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            row, tried = [], []
            for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                prefixes = [path[:n] for n in path_lengths if n <= len(path)]
                begin = 0 if len(host) <= longest_host else host.find(".", len(host) - longest_host - 1) + 1 or len(host)
                while begin < len(host):
                    tried += [host[begin:] + p for p in prefixes]
                    row += [i] * len(prefixes)
                    begin = host.find(".", begin) + 1 or len(host)
            value = listed.look_up([k.encode() for k in tried])
            rule, blocked = [None] * len(hosts), [False] * len(hosts)
            by_rule = [False] * len(hosts)
            for k in np.flatnonzero(value):
                i, key = row[k], tried[k]
                if value[k] & _RULE:
                    # a longer host is tried before a shorter one
                    if rule[i] is None or len(key) > len(rule[i]):
                        rule[i], by_rule[i] = key, bool(value[k] & _BLOCK)
                else:
                    blocked[i] = True
            verdict = ["block" if (b if r is None else v) else "allow" for r, v, b in zip(rule, by_rule, blocked, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("host"), batch.column("path"), pa.array(rule, pa.string()),
                 pa.array(verdict, pa.string())], schema=_FOUND)
    return judged


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """Host, path, deciding rule and verdict of each row of ``pages`` (page_id, url).

    ``rules`` has rule (host and path prefix, like ``example.net/en/``) and
    verdict ("block" or "allow"), ``listed`` has host; NULL entries are ignored.
    """
    lower = lambda c: F.translate(c, _UPPER, _LOWER)
    host = F.regexp_extract("rule", r"(?s)^([^/]*)(.*)$", 1)
    entries = rules.where("rule IS NOT NULL AND verdict IS NOT NULL").select(
        lower(host).alias("host"), F.regexp_extract("rule", r"(?s)^([^/]*)(.*)$", 2).alias("path"),
        (_RULE + F.when(F.col("verdict") == "block", _BLOCK).otherwise(0)).cast("int").alias("value"))
    entries = entries.unionByName(listed.where("host IS NOT NULL").select(
        lower("host").alias("host"), F.lit("").alias("path"), F.lit(_BLOCK).alias("value")))
    names, longest_host, path_lengths = distribute(entries)
    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
                        path_of(F.col("url")).alias("path"))
    return slim.mapInArrow(_judge(names, longest_host, path_lengths),
                           "page_id bigint, host string, path string, rule string, verdict string")


# fixed values: the rules of the query, and words of host labels that make a host listed
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
WORDS = ("ads", "bets", "casino", "pills")
_LISTED = rf"(?:^|\.)((?:[^.]*-)?(?:{'|'.join(WORDS)})(?:-[^.]*)?(?:\..*)?)$"


def listed_hosts(pages: DataFrame) -> DataFrame:
    """Distinct domains of the pages' hosts, each from a label on that has one of ``WORDS`` between its hyphens."""
    return pages.select(F.regexp_extract(host_of(F.col("url")), _LISTED, 1).alias("host")).where("host <> ''").distinct()


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page by the fixed rules, else by the hosts that are listed for their words."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, spark.createDataFrame(RULES, "rule string, verdict string"), listed_hosts(pages))


OP12_SQL = rf"""
WITH parts AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{_PARTS}', 1), '{_UPPER}', '{_LOWER}') AS host,
        regexp_extract(coalesce(url, ''), '{_PARTS}', 2) AS path, row_number() OVER () AS r
    FROM pages
),
rules(rule_host, rule_path, verdict) AS (VALUES {", ".join(
    f"('{r[:r.index('/')]}', '{r[r.index('/'):]}', '{v}')" for r, v in RULES)}),
decided AS (
    SELECT r, rule_host || rule_path AS rule, verdict FROM parts JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) = 1
),
listed AS (
    SELECT DISTINCT regexp_extract(host, '{_LISTED}', 1) AS listed FROM parts WHERE regexp_extract(host, '{_LISTED}', 1) <> ''
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN EXISTS (
    SELECT 1 FROM listed WHERE host = listed OR ends_with(host, '.' || listed)) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN decided USING (r)
"""
