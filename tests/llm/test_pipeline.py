"""The pipeline's stages on a small table: each decision takes effect, clean documents stay."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from tests.llm.test_operators import _text


def test_stages(spark, tmp_path):
    item = _text(50, 30)
    texts = {i: _text(1000 + i, 80) for i in range(200)}
    for i in range(0, 200, 5):
        texts[i] += " you vile snollygoster"
    texts |= {201: texts[1], 202: texts[2] + " more", 203: item, 204: _text(3, 60) + " a@b.com é", 205: None, 206: ""}
    rows = [(i, t, "en", None, len(t or "")) for i, t in texts.items()]
    rows += [(3, texts[3], "en", None, 1), (None, _text(77, 90), None, None, None)]
    d = str(tmp_path)
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 0, int(i % 5 == 0)) for i in range(200)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    out = corpus_pipeline.run(spark, d).collect()
    kept = [r.doc_id for r in out]
    expected = [i for i in range(200) if i % 5] + [204, 205, 206, None]
    assert sorted(kept, key=str) == sorted(expected, key=str)
    assert all(r.decodes for r in out)
    by_id = {r.doc_id: r for r in out}
    assert by_id[204].n_chars == len(texts[204].replace("a@b.com", "[email]"))
    assert len(by_id[205].ids) == 0
    ids = np.frombuffer(by_id[1].ids, "<u4")
    assert len(ids) == by_id[1].n_tokens > 0


def test_all_stages_but_the_last_keep_the_columns(spark, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "decontamination", "pii", "byte_bpe"]
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, kept int")
    d = str(tmp_path)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, empty, d)
        assert out.columns == empty.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, empty, d).count() == 0


def test_near_copies_from_four_fifths_on(spark, tmp_path):
    words = _text(70, 200).split()
    edited = [f"edit{i}" if i in (30, 70, 110, 150) else w for i, w in enumerate(words)]  # 176 of 216 shingles are common
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited)), (3, _text(71, 200))], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.without_near_copies(spark, docs, str(tmp_path)).collect()) == [1, 3]
    assert all(r.kept for r in corpus_pipeline.near_dedup.near_duplicates(docs).collect())


def test_texts_of_one_id_are_judged_apart(spark, tmp_path):
    one, two = _text(80, 120), _text(81, 120)
    docs = spark.createDataFrame([(1, one), (5, one + " more"), (5, two), (5, two), (7, ""), (7, "")], "doc_id bigint, text string")
    kept = corpus_pipeline.without_near_copies(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, kept)) == [(1, one), (5, two), (7, ""), (7, "")]


def test_columns_with_the_names_of_inner_ones_stay_as_they_are(spark, tmp_path):
    d = str(tmp_path)
    spark.createDataFrame([(1, _text(50, 30))], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    schema = "doc_id bigint, text string, _row_key string, row string, record string, first_row int, check string, spans int, n_chars bigint"
    texts = _text(60, 80), _text(50, 30)
    rows = [(i, t, "a", "b", "c", i, "d", i, len(t)) for i, t in enumerate(texts, 1)] + [(3, None, "e", "f", "g", 3, "h", 4, 5)]
    docs = spark.createDataFrame(rows, schema)
    for stage in (corpus_pipeline.without_near_copies, corpus_pipeline.without_personal_data, corpus_pipeline.without_benchmark):
        out = stage(spark, docs, d)
        assert out.columns == docs.columns
        assert sorted(map(tuple, out.collect())) == [rows[0], *([rows[1]] if stage != corpus_pipeline.without_benchmark else []), rows[2]]
