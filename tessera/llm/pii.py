"""Personal data: patterns, and terms that give away what the patterns protect.

The base spans are e-mail addresses, IP addresses, card numbers (12 to 19 digits that pass
the Luhn check) and phone numbers. Around them the method is information-theoretic: over the
whole corpus it counts how often a term stands within ``NEAR_TERMS`` terms of a protected
value and how often it occurs at all. The same is counted for the value's parts (local name
and domain, network, issuer, number range) and for its kind. With the information of a value
or part ``I(e) = log2(N / n(e))`` and what is left of it once a term is known,
``I(e|t) = -log2 p(e|t)``, a term discloses the share ``1 - I(e|t) / I(e)``. There is no least
number of texts: ``p(e|t) = (n(e, t) + PRIOR q) / (n(t) + PRIOR)`` is smoothed toward
``q = p(kind|t) n(e) / n(kind)``, what the kind alone says, with ``p(kind|t)`` smoothed the
same way toward ``n(kind) / N``. So values of one text count too, and a term seen once near a
value discloses a little less than one seen with it more often. Terms that disclose
``DISCLOSED`` or more of a value or of a part become spans of kind ``term``: removed if they
never occur elsewhere, else generalised. Every occurrence of such a term is marked, in every
text; a term is any run of letters, digits, marks and ``_``, compared in lower case. Base spans
always stay; terms that overlap one are not added.

Patterns are written so that Java's engine takes time in proportion to the text: possessive
repeats, and starts only where a run of the first characters starts. They match what the
plain patterns match.

All steps are DataFrame functions. Terms and values are counted after map-side combination, so a
frequent term costs one row per task. The flagged terms, one row each, are joined to the
distinct terms of every text, and only texts that hold one are searched for their places.

Results for special rows: a null text is empty and has no spans; a null id is an ordinary
value; repeated rows get equal results; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, same, shared_folder

KINDS = ("email", "ip", "card", "phone")
TERM_KIND = "term"
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
IP_VALUE = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
_TERM_CHARS = r"\p{L}\p{M}\p{N}_"
TERM = rf"[{_TERM_CHARS}]++"
LONG_TERM = r"^\p{L}{3,}$"
WINDOW = 64
NEAR_TERMS = 4
DISCLOSED = 0.9
PRIOR = 0.5

_MATCH = "struct<s:bigint,e:bigint,v:string,l:string,r:string>"


def located(text: Column, pattern: str | Column) -> Column:
    """All matches as ``(start, end, value, text before, text after)``, in code points.

    The pieces between matches come from a split on the same pattern, and adding up lengths
    gives positions. The sums run in blocks of about the square root of the number of matches, first inside
    each block and then over the blocks: an array that grows by one costs a copy of itself, so
    one run over ``n`` matches would cost ``n * n``. A text without matches is not split.
    """
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    # The matches as the one entry of a list, or of none, so that they are found once.
    some = F.filter(F.array(matches), lambda m: F.size(m) > 0)
    return F.flatten(F.transform(some, lambda m: _placed(m, F.split(text, pattern, -1))))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _placed(matches: Column, pieces: Column) -> Column:
    def zipped(parts: Column) -> Column:
        return F.arrays_zip(matches.alias("m"), F.slice(parts, F.lit(1), F.size(matches)).alias("p"), F.slice(parts, F.lit(2), F.size(matches)).alias("q"))

    return _let(_let(pieces, zipped), _in_blocks)


def _in_blocks(entries: Column) -> Column:
    n = F.size(entries)
    width = F.ceil(F.sqrt(n)).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.ceil(n / width).cast("int") - 1), lambda b: F.slice(entries, b * width + 1, width))

    def step(a: Column, x: Column) -> Column:
        piece, match, after = x["p"], x["m"], x["q"]
        at = a["pos"] + F.length(piece)
        end = at + F.length(match)
        found = F.struct(at.alias("s"), end.alias("e"), match.alias("v"), F.right(piece, F.lit(WINDOW)).alias("l"), F.left(after, F.lit(WINDOW)).alias("r"))
        return F.struct(end.alias("pos"), F.concat(a["out"], F.array(found)).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast(f"array<{_MATCH}>").alias("out"))
    return _let(F.transform(blocks, lambda b: F.aggregate(b, start, step)), _joined)


def _joined(done: Column) -> Column:
    """The blocks' matches in a row, moved by the length of the blocks before."""
    first = F.struct(F.lit(0).cast("long").alias("pos"), F.array().cast("array<bigint>").alias("out"))
    before = F.aggregate(done, first, lambda a, x: F.struct((a["pos"] + x["pos"]).alias("pos"), F.concat(a["out"], F.array(a["pos"])).alias("out")))["out"]

    def shifted(block: Column, by: Column) -> Column:
        return F.transform(block["out"], lambda m: F.struct((m["s"] + by).alias("s"), (m["e"] + by).alias("e"), m["v"].alias("v"), m["l"].alias("l"), m["r"].alias("r")))

    return F.flatten(F.zip_with(done, before, shifted))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.ascii(digits.substr(-i, F.lit(1))) - 48
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = _digits(value)
    if kind == "ip":
        return value.rlike(IP_VALUE)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Valid matches of all kinds: ``(s, k, e, v, l, r)`` by start, then kind; ``k`` indexes ``KINDS``."""
    def of_kind(k: int, kind: str) -> Column:
        matches = F.filter(located(text, PATTERNS[kind]), lambda m: _valid(kind, m["v"]))
        return F.transform(
            matches,
            lambda m: F.struct(m["s"].alias("s"), F.lit(k).alias("k"), m["e"].alias("e"), m["v"].alias("v"), m["l"].alias("l"), m["r"].alias("r")),
        )

    return F.array_sort(F.concat(*[of_kind(k, kind) for k, kind in enumerate(KINDS)]))


def _near(mention: Column) -> Column:
    """Terms near a mention as ``(s, e, t)``: up to ``NEAR_TERMS`` of three letters or more on each
    side, and all others up to the last of those. A term cut by the window's edge is left out."""
    left = F.when(F.length(mention["l"]) == WINDOW, F.regexp_replace(mention["l"], f"^{TERM}", "")).otherwise(mention["l"])
    right = F.when(F.length(mention["r"]) == WINDOW, F.regexp_replace(mention["r"], f"{TERM}$", "")).otherwise(mention["r"])

    def moved(matches: Column, by: Column) -> Column:
        return F.transform(matches, lambda m: F.struct((m["s"] + by).alias("s"), (m["e"] + by).alias("e"), F.lower(m["v"]).alias("t")))

    def long_starts(matches: Column) -> Column:
        return F.transform(F.filter(matches, lambda m: m["v"].rlike(LONG_TERM)), lambda m: m["s"])

    before, after = located(left, TERM), located(right, TERM)
    first, last = F.get(F.reverse(long_starts(before)), F.lit(NEAR_TERMS - 1)), F.get(long_starts(after), F.lit(NEAR_TERMS - 1))
    before = F.filter(before, lambda m: first.isNull() | (m["s"] >= first))
    after = F.filter(after, lambda m: last.isNull() | (m["s"] <= last))
    return F.concat(moved(before, mention["s"] - F.length(left)), moved(after, mention["e"]))


def _entities(mention: Column) -> Column:
    """The value, its parts and its kind, as ``(kind, entity, level)``; level 2 is the kind itself."""
    kind, value = mention["k"], F.lower(mention["v"])
    digits = _digits(value)
    at = F.instr(value, "@")

    def entity(level: int, name: str, of: Column) -> Column:
        return F.struct(kind.alias("kind"), F.concat_ws(":", kind, F.lit(name), of).alias("entity"), F.lit(level).alias("level"))

    plain = F.when(kind <= KINDS.index("ip"), value).otherwise(digits)
    parts = (
        F.when(kind == KINDS.index("email"), F.array(entity(1, "local", F.left(value, at - 1)), entity(1, "domain", F.substring(value, at + 1, F.length(value)))))
        .when(kind == KINDS.index("ip"), F.array(entity(1, "net", F.substring_index(value, ".", 3))))
        .when(kind == KINDS.index("card"), F.array(entity(1, "issuer", F.left(digits, F.lit(6)))))
        .otherwise(F.array(entity(1, "range", F.left(digits, F.length(digits) - 4))))
    )
    return F.concat(F.array(entity(0, "value", plain), entity(2, "kind", F.lit(""))), parts)


def disclosing_terms(near: DataFrame, texts: DataFrame, inside: DataFrame, disclosed: float = DISCLOSED, prior: float = PRIOR) -> DataFrame:
    """``(entity, term, action)`` for ``near(kind, entity, level, term)`` and all ``texts(text)``; occurrences
    ``inside(term)`` base spans do not count."""
    joint = cut(near.groupBy("kind", "entity", "level", "term").agg(F.count(F.lit(1)).alias("n_et")))
    mentions = joint.groupBy("kind", "entity", "level").agg(F.sum("n_et").alias("n_e"))
    of_kind = mentions.filter("level = 2").select("kind", F.col("n_e").alias("n_k"))
    of_kind_term = joint.filter("level = 2").select("kind", "term", F.col("n_et").alias("n_kt"))
    terms = texts.select(F.explode(F.regexp_extract_all("text", F.lit(TERM), F.lit(0))).alias("term"))
    terms = terms.select(F.lower("term").alias("term"), F.lit(1).alias("n")).union(inside.select("term", F.lit(-1)))
    terms = cut(terms.groupBy("term").agg(F.sum("n").alias("n_t")).filter("n_t > 0"))
    total = F.lit(float(terms.agg(F.sum("n_t")).first()[0] or 1))
    found = joint.filter("level < 2").join(mentions.select("entity", "n_e"), "entity")
    found = found.join(of_kind_term, ["kind", "term"]).join(of_kind, "kind").join(terms, "term")

    def smoothed(n: Column, background: Column) -> Column:
        return (n + prior * background) / (F.col("n_t") + prior)

    by_kind = smoothed(F.col("n_kt"), F.least(F.col("n_k") / total, F.lit(1.0)))
    left = -F.log2(F.least(smoothed(F.col("n_et"), F.least(by_kind * F.col("n_e") / F.col("n_k"), F.lit(1.0))), F.lit(1.0)))
    whole = F.log2(F.greatest(total / F.col("n_e"), F.lit(2.0)))
    found = found.filter(1 - left / whole >= disclosed)
    return found.select("entity", "term", F.when(F.col("n_et") >= F.col("n_t"), "remove").otherwise("generalise").alias("action"))


def term_spans(texts: DataFrame, flagged: DataFrame) -> DataFrame:
    """``(doc_id, row_key, terms)``: every place of a flagged term, for the texts that hold one."""
    # Written as a file, so that Spark knows its size when it chooses the join.
    path = f"{shared_folder(texts.sparkSession)}/flagged-{uuid.uuid4().hex}"
    flagged.groupBy("term").agg(F.max("action").alias("action")).write.parquet(path)
    flagged = texts.sparkSession.read.parquet(path)
    held = texts.select("doc_id", "row_key", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))).alias("form"))
    held = held.withColumn("term", F.lower("form")).join(flagged, "term").groupBy("doc_id", "row_key")
    held = held.agg(F.map_from_entries(F.collect_set(F.struct("form", "action"))).alias("forms"))
    held = cut(held.withColumnsRenamed({"doc_id": "h_id", "row_key": "h_key"}))
    here = texts.join(held, same(texts.doc_id, F.col("h_id")) & (texts.row_key == F.col("h_key"))).dropDuplicates(["h_id", "h_key"])
    # The forms as they are written in the text, as whole terms.
    pattern = F.concat(F.lit(f"(?<![{_TERM_CHARS}])(?:"), F.array_join(F.map_keys("forms"), "|"), F.lit(f")(?![{_TERM_CHARS}])"))
    found = F.transform(located(F.col("text"), pattern), lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"), F.col("forms")[m["v"]].alias("action")))
    return here.select("doc_id", "row_key", found.alias("terms"))


def find_private(docs: DataFrame, disclosed: float = DISCLOSED, prior: float = PRIOR) -> DataFrame:
    """Per row: ``doc_id, row_key``, ``base`` spans ``(s, k, e, v, l, r)`` and ``terms`` ``(s, e, action)``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64("text").alias("row_key"), base_spans(text).alias("base"), F.monotonically_increasing_id().alias("row"))
    rows = cut(rows)
    near = rows.select("doc_id", "row_key", "row", F.explode("base").alias("m"))
    near = near.select("doc_id", "row_key", "row", _entities(F.col("m")).alias("entities"), F.explode(_near(F.col("m"))).alias("x"))
    near = near.select("doc_id", "row_key", "row", F.col("x.s").alias("s"), F.col("x.e").alias("e"), F.col("x.t").alias("term"), F.inline("entities"))
    inside = rows.select("row", F.explode("base").alias("m"))
    inside = inside.select("row", F.col("m.s").alias("at"), F.explode(located(F.col("m.v"), TERM)).alias("x"))
    inside = cut(inside.select("row", (F.col("at") + F.col("x.s")).alias("s"), F.lower("x.v").alias("term")).distinct())
    near = cut(near.distinct().join(inside.select("row", "s").distinct(), ["row", "s"], "left_anti"))
    flagged = disclosing_terms(near, docs.select(text.alias("text")), inside, disclosed, prior)
    spans = term_spans(docs.select("doc_id", F.xxhash64("text").alias("row_key"), text.alias("text")), flagged)
    spans = spans.withColumnsRenamed({"doc_id": "t_id", "row_key": "t_key"})
    joined = rows.join(spans, same(rows.doc_id, F.col("t_id")) & (rows.row_key == F.col("t_key")), "left")
    terms = F.coalesce("terms", F.array().cast("array<struct<s:bigint,e:bigint,action:string>>"))
    free = F.filter(terms, lambda t: ~F.exists("base", lambda b: (b["s"] < t["e"]) & (t["s"] < b["e"])))
    return joined.select("doc_id", "row_key", "base", free.alias("terms"))


def sanitise(text: Column, base: Column, terms: Column) -> Column:
    """The text with base spans as ``[KIND]``, generalised terms as ``[TERM]`` and removed terms gone."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    spans = F.concat(
        F.transform(base, lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e"), names[b["k"]].alias("by"))),
        F.transform(terms, lambda t: F.struct(t["s"].alias("s"), t["e"].alias("e"), F.when(t["action"] == "remove", "").otherwise("[TERM]").alias("by"))),
    )
    text = F.coalesce(text, F.lit(""))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(a: Column, x: Column) -> Column:
        # Of overlapping spans the first gives the replacement; the others extend what is replaced.
        before = text.substr((a["at"] + 1).cast("int"), (x["s"] - a["at"]).cast("int"))
        return F.struct(
            F.greatest(a["at"], x["e"]).alias("at"),
            F.when(x["s"] >= a["at"], F.concat(a["out"], before, x["by"])).otherwise(a["out"]).alias("out"),
        )

    return F.aggregate(F.array_sort(spans), start, step, lambda a: F.concat(a["out"], text.substr((a["at"] + 1).cast("int"), F.length(text))))


def digests(found: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and all spans as text, from :func:`find_private`."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def lines(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")

    base = F.transform("base", lambda b: F.struct(b["s"].alias("s"), b["k"].alias("k"), b["e"].alias("e"), names[b["k"]].alias("kind")))
    terms = F.transform("terms", lambda t: F.struct(t["s"].alias("s"), F.lit(len(KINDS)).alias("k"), t["e"].alias("e"), F.lit(TERM_KIND).alias("kind")))

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda b: b["k"] == k)).cast("long")

    counts = [count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(lines(base).cast("binary"), 256).alias("base_sha256"), lines(F.array_sort(F.concat(base, terms))).alias("spans"))
