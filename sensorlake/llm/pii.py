"""Personal data by fixed patterns, and by contexts that are learnt from them.

Seeds are the e-mail addresses, IP addresses, card and phone numbers that fixed
expressions find. The two words before a seed are a lexical pattern. Patterns
and the values that follow them form a graph, whose two sides are scored in
turns: a pattern by the share of its distinct values that are known (smoothed,
so a pattern needs many), a value by its best pattern. Values of the right form
behind patterns of high confidence are identifiers that no expression found.

All steps are DataFrame operations. Text stays in the stage that reads it: only
matches and the ends of the gaps between them are shuffled. Places follow from
the lengths of gaps and matches before them, added up per document and kind.
The graph holds every pair of pattern and value once, so a frequent pattern is
summed up in each task before its counts meet.

Defined cases: NULL text counts as empty and has no spans; rows with the same id
and text get the same spans and are returned as often as they come in, NULL ids
too; an empty table gives no rows; other columns are ignored. Every expression
passes over a text in linear time, however long a word or a number is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from .common import no_null, stored, table

KINDS = ("email", "ip", "card", "phone")
CONFIDENT = 0.8
ROUNDS = 3
_FREE = "free"
# A run of characters that can begin a match is entered at its first character only, or where the match
# before ended: from any later one the match would fail in the same way.
_FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # a word with an @, or words with a digit, as far as single blanks join them
    _FREE: r"(?<![^\x20\x09-\x0D])(?:[^\x20\x09-\x0D@]*+@[^\x20\x09-\x0D]*+|[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
           r"(?:\x20(?![^\x20\x09-\x0D@]*+@)[^\x20\x09-\x0D0-9]{0,2}+[0-9][^\x20\x09-\x0D]*+)*+)",
}
_NEEDS = {"email": "@", "phone": "+"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _holds(kind: Column, value: Column) -> Column:
    """Whether a match of a kind's expression is an instance of it."""
    digits = _digits(value)
    n = F.length(digits)
    return (
        (kind == "email")
        | ((kind == "ip") & value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        | ((kind == "card") & n.between(14, 19) & F.call_function("luhn_check", F.when(n.between(14, 19), digits).otherwise("0")))
        | ((kind == "phone") & n.between(10, 15)))


def _resembles(value: Column) -> Column:
    """The kind that a value without a kind could be, by its form; NULL if none."""
    n = F.length(_digits(value))
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike("[A-Za-z]"), None)
        .when(value.rlike(r"^[^0-9]*[0-9]{1,3}(?:[.:][0-9]{1,3}){3}[^0-9]*$"), "ip")
        .when(n.between(14, 19), "card")
        .when(n.between(7, 13), "phone"))


def _last_words(text: Column) -> Column:
    """The last two words, and what follows the last blank behind them."""
    return F.substring_index(F.regexp_replace(text, r"[\x20\x09-\x0D]++", " "), " ", -3)


def _matches(text: Column, kind: str) -> Column:
    """The matches of a kind in order, each with the length and the end of the gap before it."""
    form = _FORMS[kind]
    parts = F.arrays_zip(
        F.split(text, form, -1).alias("gap"), F.regexp_extract_all(text, F.lit(form), F.lit(0)).alias("value"))
    found = F.transform(parts, lambda p, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(p["gap"]).alias("gap"), p["value"].alias("value"),
        _last_words(p["gap"]).alias("tail")))
    present = text.contains(_NEEDS[kind]) if kind in _NEEDS else text.rlike("[0-9@]" if kind == _FREE else "[0-9]")
    return F.filter(F.when(present, found), lambda m: m["value"].isNotNull())


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key that equal rows share."""
    text = no_null(F.col("text"))
    return docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("row"),
                       F.crc32(text.cast("binary")).alias("check"))


def occurrences(keyed: DataFrame) -> DataFrame:
    """Instances of the four kinds, and other values of a similar form that touch none: (row, check, kind,
    begin, end, value, tail, base)."""
    every = F.concat(*[F.coalesce(_matches(F.col("text"), k), F.array()) for k in _FORMS])
    found = keyed.select("row", "check", F.explode(every).alias("m")).select("row", "check", "m.*")
    # equal rows give equal matches: one of each
    found = found.groupBy("row", "check", "kind", "i").agg(
        F.first("gap").alias("gap"), F.first("value").alias("value"), F.first("tail").alias("tail"))
    size = F.length("value")
    places = Window.partitionBy("row", "check", "kind").orderBy("i")
    upto = places.rowsBetween(Window.unboundedPreceding, 0)
    placed = found.withColumn("end", F.sum(F.col("gap") + size).over(upto)).withColumn("begin", F.col("end") - size)
    placed = _with_context(placed, places, upto)
    base = (F.col("kind") != _FREE) & _holds(F.col("kind"), F.col("value"))
    placed = placed.withColumn("base", base).where("base").unionByName(_trimmed(placed.where(F.col("kind") == _FREE)))
    # a free value counts if it overlaps no instance
    order = Window.partitionBy("row", "check").orderBy("begin", F.col("base").desc())
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    ahead = F.min(F.when(F.col("base"), F.col("begin"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    alone = (F.coalesce(reached, F.lit(0)) <= F.col("begin")) & (F.coalesce(ahead, F.col("end")) >= F.col("end"))
    return placed.withColumn("alone", alone).where("base OR alone").select(
        "row", "check", "kind", "begin", "end", "value", "tail", "base")


def _with_context(placed: DataFrame, places: WindowSpec, upto: WindowSpec) -> DataFrame:
    """Matches whose ``tail`` reaches over the matches before them, as far as two words need.

    Matches without a blank between them or in the first one are a chain. Before
    each chain there is a blank, so three chains and the gaps before them hold two
    whole words. What hangs on a match without a blank has an empty tail: values
    without a kind begin at a word, so no pattern of its would ever meet one.
    """
    blank = r"[\x20\x09-\x0D]"
    opens = F.col("tail").rlike(blank) | F.coalesce(F.lag("value").over(places).rlike(blank), F.lit(True))
    chains = placed.withColumn("opens", opens).withColumn("chain", F.sum(F.col("opens").cast("int")).over(upto)).groupBy(
        "row", "check", "kind", "chain").agg(
        F.array_sort(F.collect_list(F.struct("i", "begin", "end", "value", "tail"))).alias("members"))
    joined = F.array_join(F.transform("members", lambda m, k: F.concat(F.when(k > 0, m["tail"]).otherwise(""), m["value"])), "")
    chains = chains.withColumn("head", F.col("members")[0]["tail"]).withColumn("joined", _last_words(joined))
    order = Window.partitionBy("row", "check", "kind").orderBy("chain")
    parts = [F.lag(c, n).over(order) for c, n in (("joined", 3), ("head", 2), ("joined", 2), ("head", 1), ("joined", 1))]
    return chains.withColumn("context", F.concat_ws("", *parts, F.col("head"))).select(
        "row", "check", "kind", "context", F.posexplode("members").alias("k", "m")).select(
        "row", "check", "kind", "m.begin", "m.end", "m.value", F.when(F.col("k") == 0, F.col("context")).otherwise("").alias("tail"))


def _trimmed(free: DataFrame) -> DataFrame:
    """Free values without marks around them, with the kind that they resemble."""
    head = F.length(F.regexp_extract("value", r"^[^0-9A-Za-z+(@]*+", 0))
    value = F.regexp_replace(F.regexp_replace("value", r"^[^0-9A-Za-z+(@]++", ""), r"[^0-9A-Za-z)]++$", "")
    return free.withColumns({"begin": F.col("begin") + head, "value": value}).withColumns({
        "end": F.col("begin") + F.length("value"), "kind": _resembles(F.col("value")), "base": F.lit(False),
    }).where("kind IS NOT NULL")


def _pattern() -> Column:
    """The two words before a match, lower-cased and with digits made equal; empty if there are fewer."""
    words = F.regexp_extract(
        F.lower("tail"), r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]++[\x20\x09-\x0D]++[^\x20\x09-\x0D]++[\x20\x09-\x0D]*+$", 0)
    return F.regexp_replace(F.regexp_replace(words, "[0-9]+", "0"), r"[\x20\x09-\x0D]+", " ")


def confident_patterns(found: DataFrame, confident: float = CONFIDENT, rounds: int = ROUNDS) -> DataFrame:
    """Patterns (kind, pattern) whose score reaches ``confident`` after ``rounds`` turns over the graph."""
    edges = stored(
        found.select("kind", _pattern().alias("pattern"), "value", "base").where("pattern <> ''")
        .groupBy("kind", "pattern", "value").agg(F.max("base").alias("known")), "graph")
    scored = edges.withColumn("score", F.col("known").cast("double"))
    for _ in range(rounds):
        patterns = scored.groupBy("kind", "pattern").agg(
            (F.sum("score") / (F.count("*") + 1)).alias("confidence"))
        best = edges.join(patterns, ["kind", "pattern"]).groupBy("kind", "value").agg(
            F.max("confidence").alias("confidence"))
        scored = stored(edges.join(best, ["kind", "value"]).select(
            "kind", "pattern", "value", "known",
            F.when(F.col("known"), 1.0).when(F.col("confidence") >= confident, F.col("confidence")).otherwise(0.0)
            .alias("score")), "graph")
    return scored.groupBy("kind", "pattern").agg((F.sum("score") / (F.count("*") + 1)).alias("confidence")).where(
        F.col("confidence") >= confident).select("kind", "pattern")


def personal_data(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The keyed rows of ``docs``, and the spans (row, check, kind, begin, end, base) in them."""
    keyed = _keyed(docs)
    found = stored(occurrences(keyed), "occurrences")
    learnt = found.where("NOT base").withColumn("pattern", _pattern()).join(
        confident_patterns(found), ["kind", "pattern"], "left_semi")
    columns = ("row", "check", "kind", "begin", "end", "base")
    return keyed, found.where("base").select(*columns).unionByName(learnt.select(*columns))


def _joined(spans: Column) -> Column:
    """Spans as kind:start:end by start, then kind."""
    names = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"]))
    return F.array_join(names, ",")


def span_lists(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: its id and text, the lists ``spans`` and ``base`` of struct(begin, place, end, kind)."""
    keyed, spans = personal_data(docs)
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("begin", place.alias("place"), "end", "kind")
    per_row = spans.groupBy("row", "check").agg(
        F.collect_list(span).alias("spans"), F.collect_list(F.when(F.col("base"), span)).alias("base"))
    return keyed.select("doc_id", "row", "check").join(per_row, ["row", "check"], "left").select(
        "doc_id", F.coalesce("spans", F.array()).alias("spans"), F.coalesce("base", F.array()).alias("base"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole document."""
    found = span_lists(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span in its texts replaced by [kind]; all columns and rows stay.

    Overlapping spans are replaced by the mark of the first one.
    """
    keyed, spans = personal_data(docs)
    per_row = spans.groupBy("row", "check").agg(F.array_sort(F.collect_list(F.struct("begin", "end", "kind"))).alias("spans"))
    text = no_null(F.col("text"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"), F.xxhash64("doc_id", text).alias("row"),
                       F.crc32(text.cast("binary")).alias("check"))
    # whole texts are dealt by their key in the same way at every size
    rows = rows.join(per_row.hint("merge"), ["row", "check"], "left")
    text = F.col("record.text")
    # from the list of spans: the kept stretches and the marks between them
    state = F.aggregate(
        "spans", F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")),
        lambda s, m: F.when(m["begin"] + 1 < s["at"], F.struct(F.greatest(s["at"], m["end"] + 1).alias("at"), s["parts"].alias("parts")))
        .otherwise(F.struct(
            (m["end"] + 1).cast("long").alias("at"),
            F.concat(s["parts"], F.array(
                F.substring(text, s["at"].cast("int"), (m["begin"] + 1 - s["at"]).cast("int")),
                F.concat(F.lit("["), m["kind"], F.lit("]")))).alias("parts"))),
        lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(text, s["at"].cast("int"), F.length(text))))
    new = F.when(F.col("spans").isNull(), text).otherwise(state)
    return rows.select(*[(new if c == "text" else F.col(f"record.`{c}`")).alias(c) for c in docs.columns])
