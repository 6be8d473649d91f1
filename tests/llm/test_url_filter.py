"""URL verdicts against a loop over all rules and hosts."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sensorlake.llm import url_filter as uf

SCHEMA = "page_id bigint, url string, html string, host string, rule string, key bigint"


def _split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.find(c) for c in "?#" if c in rest]
    rest = rest[:min(ends)] if ends else rest
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def _fits(host, path, entry_host, entry_path):
    return entry_host and (host == entry_host or host.endswith("." + entry_host)) and path.startswith(entry_path)


def _plain(urls, rules, listed):
    out = []
    for page_id, url in urls:
        host, path = _split(url)
        fitting = []
        for rule, verdict in rules:
            rule_host, slash, rest = rule.partition("/")
            if _fits(host, path, rule_host.lower(), slash + rest):
                fitting.append((len(rule), len(rule_host), verdict == "block", rule_host.lower() + slash + rest, verdict))
        if fitting:
            *_, rule, verdict = max(fitting)
        else:
            rule, verdict = None, "block" if any(_fits(host, path, x, "") for x in listed) else "allow"
        out.append((page_id, host, path, rule, verdict))
    return Counter(out)


def _pages(spark, urls):
    return spark.createDataFrame([(*u, "<p>", "clash", "clash", 7) for u in urls], SCHEMA).repartition(3)


ODD = ["HTTP://Www.Example.NET/en/1", "example.net/en/", "http://", "://net/", "x://NET", "x://net/", "x://net?a=/en/", "x://net#/", "a://b://net/",
       "x://example.net/EN/", "x://example.net/en", "x://notexample.net/en/1", "x://a.b.org/fr/", "x://org/fr/x?y#z", "x://example.com/de/",
       "x://.net/", "x://net./", "x://net:80/", "x://İ.net/", "x://ÉCOLE.org/fr/", "x://a\nb.net/\nen", "", " ", "x://m.casino-win.example.com/",
       "x://casinos.example.com/", "x://a.ads.bets.com", "x://deep.a.ads.bets.com/x", "x://pills", "x://y.pills", "x://pills.net/", "x://-ads-.de",
       "x://" + "a." * 30_000 + "net/" + "b/" * 30_000, "x://" + "casino" * 20_000 + ".com/"]


@pytest.fixture(scope="module")
def urls():
    rng = random.Random(1)
    made = [f"http{'s' * rng.randrange(2)}://{'.'.join(rng.choices(['a', 'www', 'free-bets', 'example', 'x-ads'], k=rng.randrange(1, 4)))}."
            f"{rng.choice(['net', 'org', 'com', 'de'])}/{rng.choice(['en', 'de', 'fr', 'e'])}{rng.choice(['', '/', '/1', '?q', '#t'])}"
            for _ in range(600)]
    urls = [(i, u) for i, u in enumerate([*made, *ODD, None])]
    return urls + urls[:3] + [(None, "x://net/"), (None, None), (-1, None)]


def test_query(spark, tmp_path, urls):
    _pages(spark, urls).write.parquet(f"{tmp_path}/pages.parquet")
    df = uf.op12_url_filter(spark, str(tmp_path))
    assert df.columns == ["page_id", "host", "path", "rule", "verdict"]
    hosts = {r[0] for r in uf.listed_hosts(_pages(spark, urls)).collect()}
    assert {"casino-win.example.com", "ads.bets.com", "pills", "-ads-.de"} <= hosts
    assert not any("casinos" in h for h in hosts)
    expected = _plain(urls, uf.RULES, hosts)
    assert {r[3] for r in expected} == {"net/", "example.net/en/", "example.com/de/", "org/fr/", None}
    assert Counter(map(tuple, df.collect())) == expected


def test_many_entries_in_many_parts(spark, urls, monkeypatch):
    monkeypatch.setattr(uf, "PART_BYTES", 4000)
    rng = random.Random(2)
    rules = [(f"{h}{p}", rng.choice(["block", "allow"])) for h in ("net", "example.net", "a.org", "x-ads.com", "COM", "")
             for p in ("", "/", "/e", "/en", "/en/", "/fr/1")]
    rules = [r for r in rules if rng.random() < 0.7 or r[0] == "COM"]
    rules += [("a.org/", "allow"), ("a.org/", "block"), ("a.org/", "allow"), (None, "block"), ("de", None)]
    listed = [f"h{i}.example.de" for i in range(2000)] + ["www.com", "example.de", "Free-Bets.org", "", None, "com", "com"]
    df = uf.judge(_pages(spark, urls), spark.createDataFrame(rules, "rule string, verdict string"),
                  spark.createDataFrame([(h, 1) for h in listed], "host string, url int"))
    known = [(r, v) for r, v in rules if r is not None and v is not None]
    assert Counter(map(tuple, df.collect())) == _plain(urls, known, {h.lower() for h in listed if h})


def test_empty_lists_and_tables(spark, urls):
    none = spark.createDataFrame([], "rule string, verdict string")
    no_hosts = spark.createDataFrame([], "host string")
    assert Counter(map(tuple, uf.judge(_pages(spark, urls), none, no_hosts).collect())) == _plain(urls, [], [])
    assert uf.judge(_pages(spark, []), none, no_hosts).collect() == []


def test_a_list_beyond_its_bound_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(uf, "MAX_LIST_BYTES", 10)
    with pytest.raises(ValueError, match="pieces"):
        uf.judge(_pages(spark, []), spark.createDataFrame(uf.RULES, "rule string, verdict string"), spark.createDataFrame([], "host string"))


def test_digests_are_those_of_spark(spark):
    keys = ["", "a", "net/", "été", "x" * 100]
    found = spark.createDataFrame([(k,) for k in keys], "k string").select(F.xxhash64("k")).collect()
    assert uf.digests_of([k.encode() for k in keys]).tolist() == [r[0] for r in found]


def test_equal_digests_are_told_apart_by_their_strings(tmp_path, monkeypatch):
    import numpy as np

    monkeypatch.setattr(uf, "digests_of", lambda keys: np.array([len(k) for k in keys], np.int64))
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"key": ["ab", "cd", "efg", "ef", "h"], "value": [1, 2, 3, 1, 2]})
    (part,) = uf._part(iter([batch]))
    (tmp_path / "part").write_bytes(part.column("part")[0].as_py())
    listed = uf.DigestArray([str(tmp_path / "part")])
    assert listed.look_up([b"ef", b"cd", b"ab", b"xx", b"efg", b"h", b"", b"abcd", b"ef"]).tolist() == [1, 2, 1, 0, 3, 2, 0, 0, 1]
