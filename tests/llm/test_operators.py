"""Every operator of the package against a brute-force version, on small fixtures with the odd cases."""

from __future__ import annotations

import hashlib
import itertools
import pickle
import re
import tracemalloc
import zlib
from collections import defaultdict
from urllib.parse import urlparse

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from sensorlake.llm import byte_bpe, chat, decontamination, near_dedup, pii, quality, sharding, suffix_dedup, token_counts, toxicity

WORDS = [a + b for a in "ban don fel gus hit jok lum mer nop ril".split() for b in "a e i o u an el is".split()]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, score double, key string"


def _text(seed: int, n: int) -> str:
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def _documents() -> list[tuple]:
    base = _text(1, 300)
    words = base.split()
    passage = _text(2, 60)
    texts = {
        0: base, 1: base, 2: " ".join([*words[:150], "other", *words[151:]]), 3: "\t" + base.upper() + "\n",
        4: _text(3, 200) + " " + passage + " " + _text(4, 40), 5: passage + "\n" + _text(5, 30),
        6: None, 7: "", 8: "short text", 9: "Short\ntext", 10: _text(6, 49), 11: "x" * 50_000, 12: "ab " * 3000,
        13: _text(7, 3000) + " " + passage + " " + passage, 14: "mail bob.ross@example.com or +1 (555) 123-4567, from 10.0.0.255",
        15: "4111 1111 1111 1111 and 4111-1111-1111-1112 a@b.c_d@e.f 1.2.3.4.5 999.1.1.1 +12", 16: " \n\t ",
        17: "été 日本語 🙂 <|endoftext|> 5555555555554444 à", 18: "#" * 60 + " " + " ".join("a$ b% c&".split() * 30),
    }
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, len(t or "")) for i, t in texts.items()]
    rows += [rows[0], rows[6], (None, base, None, None, 1), (None, None, None, None, None)]
    return [(*r, 9, 0.5, "clash") for r in rows]


@pytest.fixture(scope="module")
def documents():
    return _documents()


@pytest.fixture(scope="module")
def docs(spark, documents):
    return spark.createDataFrame(documents, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def _rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


# --- sharding

@pytest.mark.parametrize("n_shards", [1, 7, 40])
def test_shards_hold_all_rows_and_differ_by_one(spark, docs, documents, tmp_path, n_shards):
    sharding.write_shuffled(docs, str(tmp_path / "s"), bucket_bytes=1 << 12)
    out = sharding.read_shards(spark, str(tmp_path / "s"), n_shards)
    found = out.select("record.*", "shard", "slot").toPandas()
    assert sorted(map(str, out.select("record.*").collect())) == sorted(map(str, docs.collect()))
    sizes = found.iloc[:, -2].value_counts().reindex(range(n_shards), fill_value=0)
    assert sizes.max() - sizes.min() <= 1
    for shard, slots in out.select("shard", "slot").toPandas().groupby("shard")["slot"]:
        assert sorted(slots) == list(range(sizes[shard]))


def test_shuffle_is_seeded_and_not_the_input_order(spark, docs, tmp_path):
    orders = []
    for name, seed in (("a", 1), ("b", 1), ("c", 2)):
        sharding.write_shuffled(docs, str(tmp_path / name), seed=seed)
        out = sharding.read_shards(spark, str(tmp_path / name), 1).orderBy("slot").select("record.doc_id")
        orders.append([r[0] for r in out.collect()])
    assert orders[0] == orders[1] != orders[2]


def test_no_records_no_shards(spark, no_docs, tmp_path):
    sharding.write_shuffled(no_docs, str(tmp_path / "s"))
    assert sharding.read_shards(spark, str(tmp_path / "s"), 3).count() == 0


# --- token counts and byte BPE

ODD = ["", "  a  b \n\t x ", "a" * 5000, "ab" * 3000, "<s>▁x</s><0x41>", "\n\n  \n", "日本語 テキスト🙂🙂 ẞ\0x\r\n  ", " " * 999,
       "=-" * 500 + "aaaabbbbaaab" * 50, "<|endoftext|>x <|endoftext|><|endoftext|> <|endoft", "don't I'll    x　 ٣٤ ½ ²"]


def _random_texts() -> list[str]:
    rng = np.random.default_rng(3)
    return ["".join(rng.choice(list("abcde ▁  \n\té🙂'sth"), rng.integers(1, 300))) for _ in range(300)]


def test_token_counts_equal_the_library():
    import sentencepiece

    file = public_tokenizers.path("piece_bpe_32k.model")
    texts = ODD + _random_texts()
    expected = [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=file).encode(texts, num_threads=1)]
    assert token_counts.PieceCounter(file).count(texts) == expected


def test_very_long_words_are_counted_as_fast_as_short_ones():
    import base64
    import random
    import time

    import sentencepiece

    file, rng = public_tokenizers.path("piece_bpe_32k.model"), random.Random(1)
    library, counter = sentencepiece.SentencePieceProcessor(model_file=file), token_counts.PieceCounter(file)
    pieces = [library.id_to_piece(i).replace(token_counts.SPACE, "") for i in range(300, 31_000)]
    long = ["the" * 300_000, "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=900_000)), base64.b64encode(rng.randbytes(700_000)).decode(),
            "a" * 900_001, "aab" * 200_000, "".join(rng.choices(pieces, k=150_000)), "".join(_random_texts()).replace(" ", "")]
    start = time.perf_counter()
    counts = counter.count(long)
    assert time.perf_counter() - start < 60  # a round for each merge would take hours
    assert counts == [len(x) for x in library.encode(long, num_threads=1)]
    short = [c * n for c in ("a", "ab", "aab", "the", "=", "-=", "日本") for n in range(1, 90)]
    short += ["".join(rng.choices(pieces, k=rng.randint(1, 12))) for _ in range(3000)]
    short += ["".join(rng.choices("aabeinrst", k=rng.randint(1, 50))) for _ in range(3000)]
    assert counter.count(short) == [len(x) for x in library.encode(short, num_threads=1)]


def test_byte_bpe_equals_the_library_and_decodes():
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    texts, bpe = ODD + _random_texts(), byte_bpe.ByteBpe(file)
    expected = [x.ids for x in Tokenizer.from_file(file).encode_batch(texts, add_special_tokens=False)]
    ids = list(bpe.encode(texts))
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == expected
    assert [bpe.decode(x) for x in ids] == texts
    assert bpe.decode(np.array([expected[6][0]], "<u4").tobytes())  # a single id of a split character is no error


def test_token_columns_over_odd_rows(docs, documents, no_docs):
    file = public_tokenizers.path("byte_bpe_50k.json")
    coded = byte_bpe.round_trip(docs, file)
    assert all(r.decoded == (r.text or "") for r in coded.collect())
    assert byte_bpe.digest(coded).count() == len(documents)
    counted = docs.select("text", token_counts.token_count(F.col("text"), public_tokenizers.path("piece_bpe_32k.model")).alias("n"))
    assert all((r.n == 0) == (not r.text) for r in counted.collect())
    assert byte_bpe.digest(byte_bpe.round_trip(no_docs, file)).count() == 0


# --- chat

def test_escaping_is_reversible_and_hides_marks():
    for parts in itertools.product(["\\", "<|", "<", "|", "endoftext", "|>", "a"], repeat=4):
        text = "".join(parts)
        assert chat.unescape(chat.escape(text)) == text
        assert chat.MARK not in chat.escape(text + chat.MARK)


def test_mask_covers_assistant_texts_only(spark):
    said = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", " hi\n"), (1, 1, "assistant", "\n 🙂é\\"), (1, 2, "assistant", "<|endoftext|> x"), (1, 3, None, None),
            (2, 0, "assistant", None), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (None, 5, "user", "q"),
            (-7, 1, "assistant", said), (-7, 0, "user", said), (3, 0, "system", "x" * 100_000)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, turns int")
    out = {r.conv_id: r for r in chat.digest(chat.format_conversations(frame, public_tokenizers.path("byte_bpe_50k.json"))).collect()}
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn, role or "", text or ""))
    assert out.keys() == grouped.keys()
    for conv, turns in grouped.items():
        turns.sort()
        learnt = "".join(t for _, r, t in turns if r == "assistant")
        assert (out[conv].n_turns, out[conv].loss_chars) == (len(turns), len(learnt))
        assert out[conv].loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()
        assert out[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest()
    assert chat.digest(chat.format_conversations(frame.limit(0), public_tokenizers.path("byte_bpe_50k.json"))).count() == 0


def test_loss_mask_by_binary_search():
    starts, ends = np.array([0, 2, 4, 4, 6, 9]), np.array([2, 4, 6, 6, 9, 10])
    assert chat.loss_mask([(2, 4), (5, 7)], starts, ends).tolist() == [False, True, True, True, True, False]
    assert chat.loss_mask([], starts, ends).sum() == 0


# --- quality

def _figures(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    inside = {j for at in windows.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_measures_and_verdicts(docs, documents, no_docs):
    for t in [d[1] or "" for d in documents] + ODD + ["a b a b a b c", "x\nx\n\n\nx y"]:
        assert quality.measure(t) == _figures(t)
    out = quality.judged(docs).toPandas()
    assert len(out) == len(documents)
    usual = out[out.doc_id.isin([0, 1, 2, 4])]
    assert usual.kept.all()
    assert not out[out.doc_id.isin([6, 7, 8, 12, 18])].kept.any()
    assert quality.judged(no_docs).count() == 0


def test_sketch_merges_to_the_same_fences(spark, docs):
    figures = docs.select("doc_id", "lang", "source", quality._measures(F.coalesce("text", F.lit(""))).alias("m")).select(
        "doc_id", "lang", "source", "m.*").withColumns(quality._rates())
    assert _rows(quality.thresholds(figures)) == _rows(quality.thresholds(figures.repartition(5, "doc_id")))


# --- personal data

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _valid(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
        return 14 <= len(digits) <= 19 and doubled % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def _spans(text: str) -> str:
    found = sorted((m.start(), place, m.end(), kind) for place, (kind, form) in enumerate(FORMS.items())
                   for m in re.finditer(form, text) if _valid(kind, m[0]))
    return ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in found)


def _digested(frame):
    found = pii.span_lists(frame)
    return [(r[0], r[1], r[2]) for r in found.select("doc_id", pii._joined(F.col("base")), pii._joined(F.col("spans"))).collect()]


def test_base_spans(spark, docs, documents, no_docs):
    expected = sorted((str(d[0]), _spans(d[1] or "")) for d in documents)
    assert sorted((str(i), b) for i, b, _ in _digested(docs)) == expected
    rng = np.random.default_rng(5)
    odd = [(i, "".join(rng.choice(list("01245.+-@ aé()_x🙂"), 200))) for i in range(300)]
    odd += [(500, "1" * 40_000), (501, "a" * 40_000 + "@"), (502, "1 " * 20_000), (503, "+1" + "." * 30_000), (504, "0" * 300 + ".1.2.3")]
    frame = spark.createDataFrame(odd, "doc_id bigint, text string")
    assert {i: b for i, b, _ in _digested(frame)} == {i: _spans(t) for i, t in odd}
    assert pii.span_lists(no_docs).count() == 0


def test_contexts_of_seeds_find_other_values(spark):
    rows = [(i, f"hello there call me +1 ({100 + i}) 555-{1000 + i} ok {_text(i, 5)}") for i in range(30)]
    rows += [(100, "hello there call me (999) 555-7777 ok"), (101, "page number 5551234567 of the book")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = {i: (b, s) for i, b, s in _digested(frame)}
    assert out[100] == ("", "phone:20:34")
    assert out[101] == ("", "")
    assert all(out[i][0] == out[i][1] != "" for i in range(30))


def test_contexts_reach_over_numbers_and_lists(spark):
    far = "x" * 100
    rows = [(i, f"order {i} phone +49 30 {1000000 + i}") for i in range(30)]
    rows += [(100 + i, f"ask a@x.org,b@x.org,c@x.org or u{chr(97 + i)}@y.org") for i in range(26)]
    rows += [(200 + i, f"hosts 10.0.0.1\n10.0.0.{i + 2}") for i in range(30)]
    rows += [(300 + i, f"{far} card: 4111-1111-1111-1111 {far} dial +49 31 {1000000 + i}") for i in range(30)]
    rows += [(400 + i, f"kindly reach u{chr(97 + i)}@z.org") for i in range(26)]
    rows += [(900, "order 18 phone 5551234 ok"), (901, "ask a@x.org,b@x.org,c@x.org or ann@localhost"), (902, "hosts 10.0.0.1\n300.1.2.3"),
             (903, f"{far} dial 5551234"), (904, "kindly reach ann@localhost, 5551234"), (905, "see ann@localhost"), (906, "a @ b, @ 7")]
    found = _digested(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {i: s for i, _, s in found if i >= 900} == {
        900: "phone:15:22", 901: "email:4:11,email:12:19,email:20:27,email:31:44", 902: "ip:6:14,ip:15:24",
        903: "phone:106:113", 904: "email:13:26", 905: "", 906: ""}
    assert all(b == s != "" for i, b, s in found if i < 900)


def test_masking_keeps_everything_else(spark):
    rows = [(1, "mail a.b@c.de now 10.0.0.1", 5), (2, None, 6), (3, "no data é🙂", 7), (1, "mail a.b@c.de now 10.0.0.1", 5), (None, "+49 30 1234567 x", 8)]
    out = pii.masked(spark.createDataFrame(rows, "doc_id bigint, text string, begin int"))
    assert out.columns == ["doc_id", "text", "begin"]
    assert _rows(out) == _rows(spark.createDataFrame([
        (1, "mail [email] now [ip]", 5), (2, None, 6), (3, "no data é🙂", 7), (1, "mail [email] now [ip]", 5),
        (None, "[phone] x", 8)], "doc_id bigint, text string, begin int"))


# --- near duplicates

def _shingles(text: str | None) -> frozenset:
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def _components(rows: list[tuple]) -> dict:
    sets = {i: _shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(docs, documents, no_docs):
    expected = _components([(d[0], d[1]) for d in documents])
    out = near_dedup.near_duplicates(docs).collect()
    assert len(out) == len(documents)
    for r in out:
        if r.doc_id is not None:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_near_copies_of_one_base_around_the_limit(spark, monkeypatch):
    """Copies of one text with more and fewer edits: links that no leader has are found across components."""
    monkeypatch.setattr(near_dedup, "_BLOCK", 4000)
    base = _text(11, 200).split()
    rows = [(0, _text(12, 200))]
    for i in range(1, 90):
        rng = np.random.default_rng(i)
        own = list(base)
        for at in rng.choice(200, rng.integers(1, 6), replace=False):
            own[at] = f"edit{i}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(f"w{i + k}" for k in range(100))) for i in range(0, 60, 2)]  # a chain
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    expected = _components(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == expected


def test_texts_of_one_id_do_not_share_their_links(spark):
    one, two = _text(13, 120), _text(14, 120)
    rows = [(1, one), (5, one + " more"), (5, two), (9, two + " more"), (5, two), (5, None)]
    out = near_dedup.near_rows(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    keys = {t: k for t, k in spark.createDataFrame(rows, "doc_id bigint, text string").select("text", near_dedup.row_key()).collect()}
    by_row = {(r.doc_id, r.row): (r.component_id, r.first_row) for r in out}
    assert len(out) == 6
    assert by_row == {(1, keys[one]): (1, keys[one]), (5, keys[one + " more"]): (1, keys[one]), (5, keys[two]): (5, keys[two]),
                      (9, keys[two + " more"]): (5, keys[two]), (5, keys[None]): (5, keys[None])}


def test_members_of_the_largest_component_are_not_dealt_to_one_another(spark):
    members = [("k", i, 0, 100) for i in range(3000)] + [("k", 5000 + i, 5000 + i, 100) for i in range(10)]
    members += [("one", i, 7, 100) for i in range(50)]
    frame = spark.createDataFrame(members, "key string, node bigint, component bigint, n_shingles bigint")
    dealt = near_dedup.dealt_members(frame)
    blocks = -(-3010 * 100 // near_dedup._BLOCK)
    assert dealt.count() == 3010 + 10 * blocks
    assert dealt.where("seeks").select("node").distinct().count() == 10
    groups = dealt.groupBy("key", "i", "j").agg(F.sum(F.lit(100)).alias("shingles"))
    assert groups.count() == blocks and groups.agg(F.max("shingles")).first()[0] < 3 * near_dedup._BLOCK


def test_signatures_of_long_texts_without_common_shingles_differ():
    rng = np.random.default_rng(3)
    one, two = (near_dedup.signature(rng.integers(0, 2**63, 3_000_000, dtype=np.uint64)) for _ in range(2))
    assert (one == two).mean() < 0.01


def test_circulant_signature_is_minhash():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (800, 100, 100))
    one, two = near_dedup.signature(np.concatenate([common, a])), near_dedup.signature(np.concatenate([common, b]))
    assert abs((one == two).mean() - 0.8) < 0.08


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, 102), (101, 102), (7, 7)]
    out = dict(map(tuple, near_dedup.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert out == {i: 1 for i in range(1, 41)} | {100: 100, 101: 100, 102: 100}


# --- repeated passages

def _covered(rows: list[tuple]) -> dict:
    holders, words = defaultdict(set), {}
    for i, t in rows:
        if i is not None:
            words[i] = re.findall(r"[^\x20\x09-\x0D]+", t or "")
            for at in range(len(words[i]) - 49):
                holders[tuple(words[i][at:at + 50])].add(i)
    found = {i: {k for at in range(len(w) - 49) if len(holders[tuple(w[at:at + 50])]) > 1 for k in range(at, at + 50)}
             for i, w in words.items()}
    return {i: c for i, c in found.items() if c}


def test_repeated_passages(docs, documents, no_docs):
    out = suffix_dedup.repeated_passages(docs).collect()
    found = defaultdict(set)
    for r in out:
        assert r.other_id != r.doc_id and r.n_words == r.end_word - r.start_word >= 50
        found[r.doc_id].update(range(r.start_word, r.end_word))
    assert found == _covered([(d[0], d[1]) for d in documents])
    assert suffix_dedup.repeated_passages(no_docs).count() == 0


def test_passage_of_many_documents_over_many_parts(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        passage = _text(21, 55)
        rows = [(i, f"{_text(100 + i, 30)} {passage} {_text(300 + i, 30)}") for i in range(60)]
        rows += [(i, _text(500 + i, 80)) for i in range(60, 90)]
        out = suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
        found, expected = {r.doc_id: r for r in out.collect()}, _covered(rows)
        assert found.keys() == expected.keys() == set(range(60))
        for i, r in found.items():
            assert set(range(r.start_word, r.end_word)) == expected[i] and r.other_id == (1 if i == 0 else 0)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_passages_around_a_hot_core_over_many_parts(spark):
    """A core of 40 words in all documents; pairs share more around it, left, right or both, among others that share more on one side."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        core, rows = _text(41, 40).split(), []
        for i in range(400):
            left, right = ([f"{side}{i}x{k}" for k in range(30)] for side in "lr")
            pair, kind = i // 2, i // 2 % 4
            common = {0: (0, 12), 1: (12, 0), 2: (5, 5), 3: (4, 5)}[kind]
            if common[0]:
                left[-common[0]:] = [f"L{pair}x{k}" for k in range(common[0])]
            if common[1]:
                right[:common[1]] = [f"R{pair}x{k}" for k in range(common[1])]
            rows.append((i, " ".join([*left, *core, *right])))
            if kind == 2:  # one shares nine words before the core with the pair's first, one nine words behind it with its second
                rows.append((1000 + i, " ".join([*(f"o{i}x{k}" for k in range(20)), *left[-9:], *core, *(f"p{i}x{k}" for k in range(20))])))
                rows.append((2000 + i, " ".join([*(f"q{i}x{k}" for k in range(20)), *core, *right[:9], *(f"s{i}x{k}" for k in range(20))])))
        out = suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)).collect()
        found, texts = defaultdict(set), {i: t.split() for i, t in rows}
        for r in out:
            found[r.doc_id].update(range(r.start_word, r.end_word))
            windows = {tuple(texts[r.other_id][k:k + 50]) for k in range(len(texts[r.other_id]) - 49)}
            assert r.other_id != r.doc_id and any(tuple(texts[r.doc_id][k:k + 50]) in windows for k in range(r.start_word, r.end_word - 49))
        assert found == _covered(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("gathered", [4, 1 << 16])
def test_runs_of_equal_suffixes_over_many_ranges(monkeypatch, gathered):
    """Sorted suffixes cut into ranges and batches anywhere: every suffix finds the smallest other document of its run."""
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "_SORTED_ROWS", gathered)
    rng = np.random.default_rng(5)
    for trial in range(60):
        rows = sorted({(int(w), int(d), int(s)) for w, d, s in zip(
            rng.integers(-3, 3, 80), rng.choice(4, 80) if trial % 2 else rng.integers(0, 40, 80), rng.integers(0, 9, 80), strict=True)})
        cuts = sorted(rng.choice(len(rows), 5, replace=False).tolist())
        found, ends = [], defaultdict(set)
        for lo, hi in itertools.pairwise([0, *cuts, len(rows)]):
            batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.int64()),
                                                   pa.array([r[2] for r in part], pa.int32())], names=["words", "doc_id", "start_word"])
                       for part in (rows[k:min(k + 3, hi)] for k in range(lo, hi, 3))]
            for batch in suffix_dedup._neighbours(iter(batches)):
                for r in batch.to_pylist():
                    if r["start_word"] < 0:
                        ends[r["words"]].add(r["doc_id"])
                    else:
                        found.append(r)
        assert sum(map(len, ends.values())) <= 4 * 6
        got = set()
        for r in found:
            other = r["other_id"]
            if r["edge"]:
                other = min(ends[r["words"]] - {r["doc_id"]}, default=None)
            if other is not None:
                got.add((r["words"], r["doc_id"], r["start_word"], other))
        holders = defaultdict(set)
        for w, d, _ in rows:
            holders[w].add(d)
        assert len(found) == len({(r["words"], r["doc_id"], r["start_word"]) for r in found})
        assert got == {(w, d, s, min(holders[w] - {d})) for w, d, s in rows if len(holders[w]) > 1}


def test_words_with_equal_first_bits_of_their_hash_differ(spark):
    seen = {}
    for i in itertools.count():
        first = xxhash.xxh3_64_intdigest(f"w{i}".encode()) >> 48
        if first in seen:
            break
        seen[first] = i
    core, one, two = _text(51, 49), f"w{seen[first]}", f"w{i}"
    rows = [(1, f"{_text(52, 30)} {core} {one} a b c"), (2, f"{_text(53, 30)} {core} {two} d e f"),
            (3, f"{_text(54, 30)} {one} {core} g h i"), (4, f"{_text(55, 30)} {two} {core} j k l")]
    assert not _covered(rows)
    assert suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string")).collect() == []


def test_a_repeated_word_goes_to_no_single_task(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = [(1, "ab " * 5000), (2, f"{_text(61, 40)} {'ab ' * 60}"), (3, _text(62, 90))]
        out = suffix_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id bigint, text string"))
        assert {(r.doc_id, r.start_word, r.end_word, r.other_id) for r in out.collect()} == {(1, 0, 5000, 2), (2, 40, 100, 1)}
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Coalesce 1" not in plan and "SinglePartition" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


# --- decontamination

def _hits(text: str | None, items: list[tuple]) -> tuple:
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, found = split(text), set(), set()
    for item, t in items:
        own = split(t)
        for window in {tuple(own[i:i + 13]) for i in range(max(1, len(own) - 12))} if own else ():
            for at in range(len(words) - len(window) + 1):
                if tuple(words[at:at + len(window)]) == window:
                    hit.update(range(at, at + len(window)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_contamination(spark, block_bytes):
    item = _text(31, 30)
    items = [(1, item), (10, "Two, words!"), (2, None), (3, " .,"), (4, _text(32, 12)), (5, item.upper()), (6, "été x")]
    texts = [item, f"{_text(33, 20)} {' '.join(item.split()[5:19])} tail", "two\nWORDS two words", None, "", "words two",
             _text(32, 12), " ".join(item.split()[:12]), "un été_x", item, _text(34, 5000) + " " + item]
    docs = spark.createDataFrame([(i % 10, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, positions int").repartition(2)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontamination.contamination(docs, bench, block_bytes=block_bytes)
    found = sorted((r.doc_id, r.n_words, r.n_hit, sorted(r.item_ids)) for r in out.collect())
    assert found == sorted((i % 10, *_hits(t, items)) for i, t in enumerate(texts))
    assert decontamination.contamination(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in decontamination.contamination(docs, bench.limit(0)).collect()} == {0}


def test_index_has_a_row_group_for_each_block(spark):
    text = "filler " * decontamination._BLOCK_WORDS + "alpha beta gamma"
    docs = spark.createDataFrame([(i, text) for i in range(3)] + [(3, "alpha beta gamma")], "doc_id bigint, text string").coalesce(1)
    index = decontamination.build_index(docs)
    files = [pq.ParquetFile(urlparse(path).path).metadata for path in index.inputFiles()]
    assert [[f.row_group(i).num_rows for i in range(f.num_row_groups)] for f in files if f.num_rows] == [[1, 1, 1, 1]]
    out = decontamination.search(index, [(1, "alpha beta gamma")])
    assert sorted((r.doc_id, r.n_words, len(r.hit_words)) for r in out.collect()) == [
        *((i, decontamination._BLOCK_WORDS + 3, 3) for i in range(3)), (3, 3, 3)]


def test_proximity_matches(spark):
    docs = spark.createDataFrame([(1, "alpha big beta gamma"), (2, "alpha beta gamma"), (3, "gamma beta alpha zeta zeta")], "doc_id bigint, text string")
    out = decontamination.search(decontamination.build_index(docs), [(1, "alpha beta gamma")], slop=1)
    assert {r.doc_id: (len(r.hit_words), r.n_near > 0) for r in out.collect()} == {1: (0, True), 2: (3, True), 3: (0, False)}


@pytest.mark.parametrize("window", [1, 2, 3, 13])
def test_windows_of_benchmark_items(window):
    rng = np.random.default_rng(5)
    items = [(i % 150 or None, " ".join(rng.choice(list("abcd"), rng.integers(0, 20)))) for i in range(300)]
    items += [(1, None), (-4, "a b"), (-4, "a b")]
    wanted: dict[tuple, set] = {}
    for item, text in items:
        own = (text or "").split()
        for i in range(max(1, len(own) - window + 1) if own else 0):
            wanted.setdefault(tuple(own[i:i + window]), set()).add(item)
    phrases = decontamination._Phrases(items, window)
    word = {decontamination._term(w.encode()): w for w in "abcd"}
    found = {tuple(word[phrases.hashes[t]] for t in phrases.words[s:s + n]): phrases.items_of(w)
             for w, (s, n) in enumerate(zip(phrases.starts, phrases.lengths, strict=True))}
    assert len(found) == len(phrases.starts)
    assert found == {w: sorted(ids - {None}) for w, ids in wanted.items()}


def test_a_block_of_benchmark_items_takes_little_memory():
    items = [(i, _text(i, 100)) for i in range(500)]
    tracemalloc.start()
    try:
        decontamination._Phrases(items, decontamination.WINDOW)
        # every task holds it, for 8 MB of text
        assert tracemalloc.get_traced_memory()[1] < 40 * sum(len(t) for _, t in items)
    finally:
        tracemalloc.stop()


# --- toxicity

def _grams(text: str) -> set:
    line = " " + " ".join(text.lower().split()) + " "
    return {line[i:i + n] for i in range(1, len(line)) if line[i] != " " and (line[i - 1] == " " or ord(line[i]) >= 0x2E80)
            for n in toxicity._SIZES if i + n <= len(line)}


def test_toxicity_features_are_the_grams_at_words():
    def number(gram):
        found = ord(gram[0])
        for c in gram[1:]:
            found = (found * 0x100000001B3 + ord(c)) % 2**64
        return ((found ^ len(gram) << 56) * 0x9E3779B97F4A7C15 % 2**64) >> 64 - toxicity._BITS

    for text in ["", " ", "a", "one two", "Été  à\n\tl'été", "日本語のテキスト and more", "x" * 3000, "a " * 500, _text(5, 200), "\ud800 lone"]:
        assert sorted(toxicity.features(text).tolist()) == sorted({number(g) for g in _grams(text)})


def test_toxicity_equals_an_independent_fit(spark):
    """Ratios and a penalised logistic regression on plain strings, by many plain gradient steps."""
    rng, texts = np.random.default_rng(9), {}
    for i in range(240):
        texts[i] = _text(2000 + i, int(rng.integers(20, 60))) + (f" {rng.choice(['snolly', 'blatherskite'])}{rng.choice(['er', 'ing'])}" if i % 4 == 0 else "")
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    labels = {i: int(i % 4 == 0) if rng.random() > 0.05 else int(i % 4 != 0) for i in texts}
    model = toxicity.fit(docs, spark.createDataFrame([(i, 0, y) for i, y in labels.items()], "doc_id bigint, quality int, toxic int"))
    fold = [i for i in texts if zlib.crc32(str(i).encode()) % 4 != 2]
    sets, y = [_grams(texts[i]) for i in fold], np.array([labels[i] for i in fold], float)
    counts = defaultdict(lambda: [0, 0])
    for grams, label in zip(sets, y, strict=True):
        for g in grams:
            counts[g][int(label)] += 1
    n1, n0 = y.sum(), len(y) - y.sum()
    ratio = {g: np.log((t + 0.5) / (n1 + 1)) - np.log((o + 0.5) / (n0 + 1)) for g, (o, t) in counts.items() if o + t >= toxicity._LEAST_DOCS}
    ratio = {g: r for g, r in ratio.items() if abs(r) >= toxicity._LEAST_RATIO}
    column = {g: k for k, g in enumerate(ratio)}
    x = np.zeros((len(fold), len(column)))
    for row, grams in enumerate(sets):
        for g in grams & column.keys():
            x[row, column[g]] = ratio[g]
    weights, bias, step = np.zeros(len(column)), 0.0, 1 / (np.linalg.norm(x, 2) ** 2 / (4 * len(y)) + toxicity._PENALTY)
    for _ in range(20_000):
        missed = 1 / (1 + np.exp(-(x @ weights + bias))) - y
        weights -= step * (x.T @ missed / len(y) + toxicity._PENALTY * weights)
        bias -= missed.mean()
    def scores(weights, bias):
        return {i: 1 / (1 + np.exp(-(bias + sum(weights[column[g]] * ratio[g] for g in _grams(t) & column.keys())))) for i, t in texts.items()}

    own, found = scores(weights, bias), {i: model.score(t) for i, t in texts.items()}
    # the model stops after a fixed number of steps, so it is near the optimum, not in it
    loss = lambda p: -np.mean([np.log(p[i] if labels[i] else 1 - p[i]) for i in fold])
    size = lambda w: toxicity._PENALTY / 2 * np.sum(np.square(w))
    assert loss(found) < loss(own) + size(weights) + 0.1
    assert np.corrcoef(list(own.values()), list(found.values()))[0, 1] > 0.97
    # the same number of accelerated steps in dense matrices
    weights, bias = np.zeros(len(column)), np.log((n1 + 0.5) / (n0 + 2))
    ahead = weights
    for i in range(toxicity._STEPS):
        missed = 1 / (1 + np.exp(-(x @ ahead + bias))) - y
        stepped = ahead - step * (x.T @ missed / len(y) + toxicity._PENALTY * ahead)
        ahead, weights = stepped + i / (i + 3) * (stepped - weights), stepped
        bias -= 0.5 * missed.mean()
    same = scores(weights, bias)
    assert max(abs(same[i] - found[i]) for i in texts) < 0.03
    assert np.mean([(found[i] >= toxicity.THRESHOLD) == (i % 4 == 0) for i in texts]) > 0.97


def test_toxicity_learns_from_labels(spark, no_docs):
    rows = [(i, _text(i, 40) + (" you vile snollygoster " if i % 4 == 0 else " ") + _text(900 + i, 40)) for i in range(800)]
    rows += [(None, None), (-1, ""), (5, rows[5][1])]
    labels = [(i, 0, int(i % 4 == 0)) for i in range(800)] + [(None, 0, 1), (-5, 0, None), (3, 0, 7)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id bigint, text string, score double")
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(docs, marks)
    out = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held"), toxicity.toxicity(F.col("text"), model).alias("p")).collect()
    assert len(out) == len(rows) and all(0 <= r.p <= 1 for r in out)
    for r in out:
        if r.doc_id is not None and r.doc_id >= 0:
            assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
            assert (r.p >= toxicity.THRESHOLD) == (r.doc_id % 4 == 0)
    # labels of the held-out fold change nothing
    turned = marks.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert np.allclose(toxicity.fit(docs, turned).weights, model.weights)
    assert 0 <= toxicity.fit(docs, marks.limit(0)).score("text") < toxicity.THRESHOLD
    assert no_docs.select(toxicity.toxicity(F.col("text"), model)).count() == 0


def test_toxicity_counts_features_in_spark(spark):
    texts = [(i % 3 == 0, _text(3000 + i, 12)) for i in range(60)] + [(True, "")]
    sample = spark.createDataFrame([(int(y), t) for y, t in texts], "label int, text string").repartition(3)
    counts = defaultdict(lambda: [0, 0])
    for y, t in texts:
        for g in toxicity.features(t).tolist():
            counts[g][y] += 1
    found = toxicity.class_counts(sample).collect()
    assert sorted(map(tuple, found)) == sorted((g, *n) for g, n in counts.items() if sum(n) >= toxicity._LEAST_DOCS)


def test_toxicity_needs_little_of_the_driver(spark):
    """No vector of all hashed places for each task goes through the driver, nor into the scoring of texts."""
    rows = [(i, _text(i, 40) + (" you vile snollygoster" if i % 4 == 0 else "")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    tracemalloc.start()
    try:
        model = toxicity.fit(docs, labels)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 16 << 20
    sent = pickle.dumps(model)
    assert len(sent) < 1 << 20
    same = pickle.loads(sent)
    assert (same.weights == model.weights).all() and same.weights.any() and same.bias == model.bias
    assert [same.score(t) for _, t in rows] == [model.score(t) for _, t in rows]
