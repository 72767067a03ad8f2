"""Each operator against brute force on small tables with nulls, empties, ties and repeats."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import ann, chat, exact_dedup, langid, mixing, ngram_join, packing, pii, suffix_dedup, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, rank int"
WORDS = [f"w{i}" for i in range(400)]


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]]) with extra columns whose names clash with results."""
    full = [(r[0], r[1], *(r[2:] if len(r) > 2 else (None,)), *((None,) if len(r) < 4 else ()), None, "x", 1) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


LONG = prose(1, 6000)
MIXED = [
    (1, None), (2, ""), (3, "  \n\t "), (4, LONG), (5, LONG), (5, LONG), (6, LONG + "x"), (7, LONG[:-1]),
    (8, "a"), (9, "a"), (None, "a"), (None, None), (10, "12 é中 \U0001f600"), (11, prose(2, 300)),
]


@pytest.mark.parametrize("block", [7, 64, 4096])
def test_exact_dedup(spark, block):
    got = exact_dedup.exact_dedup(documents(spark, MIXED), block_bytes=block).collect()
    assert len(got) == len(MIXED)
    groups = collections.defaultdict(list)
    for i, t in MIXED:
        groups[hashlib.sha256((t or "").encode()).hexdigest()].append(i)
    for r in got:
        ids = groups[r.text_sha256]
        best = max((i for i in ids if i is not None), default=None)
        assert (r.keep_id, r.group_size) == (best, len(ids))
    for sha, ids in groups.items():
        assert sum(r.kept for r in got if r.text_sha256 == sha) == 1
    kept = exact_dedup.drop_exact_duplicates(documents(spark, MIXED), block_bytes=block)
    assert sorted(r.text or "" for r in kept.collect()) == sorted({t or "" for _, t in MIXED})


def test_exact_dedup_tells_texts_of_one_hash_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(5).cast("long"))
    got = exact_dedup.exact_dedup(documents(spark, [(1, "aa"), (2, "bb"), (3, "aa")]), block_bytes=4).collect()
    assert sorted((r.doc_id, r.keep_id) for r in got) == [(1, 3), (2, 2), (3, 3)]


def test_empty_tables(spark):
    empty = documents(spark, [])
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert mixing.mix_sizes(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0
    assert langid.identify(empty, langid.fit_on(empty, F.lit(True))).count() == 0
    assert ngram_join.link_components(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert pii.digests(pii.find_private(empty)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(empty.select("doc_id", "text"), toxicity.fit(empty, labels, F.lit(True))).count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 2 == 0).count() == 0
    assert chat.conversation_digests(chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0


def test_mixing_targets_and_rates(spark):
    rows = [(i, prose(i, 3 + i * (1 + i % 7) % 41 + i % 7), None, ["a", "b", "c", None][min(3, i % 7)]) for i in range(700)] + [(None, None, None, "zz")]
    got = mixing.mix_sizes(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    order = ["a", "b", "c", "zz", None]
    weight = dict(zip(order, [5, 2, 1, 5, 2]))
    total, capped, target = sum(sizes.values()), {s for s in order if not sizes[s]}, {}
    while True:  # share, cap, share the excess again
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / w for s in order}
        over = {s for s in order if s not in capped and target[s] > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    by_size = {sizes[s]: target[s] for s in order}
    taken = collections.Counter()
    for r in got:
        assert r.target == pytest.approx(by_size[r.source_size])
        assert r.taken <= 3 * r.size
        taken[r.source_size] += r.taken
    for s in order:
        assert abs(taken[sizes[s]] - target[s]) <= max(60, 0.05 * target[s])
    again = mixing.mix_sizes(documents(spark, rows).repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix_documents(documents(spark, rows)).count() == sum(r.copies for r in got)


def test_mixing_keeps_the_probability_of_small_sources(spark):
    # 300 sources of one document each: rates 0.375 (weight 5), 0.15 (weight 2) and 0.075 (weight 1), and the rest in one large source.
    rows = [(i, prose(i, 8), None, f"s{i:04d}") for i in range(900)] + [(1000 + i, prose(i, 40), None, "zz") for i in range(30)]
    got = mixing.mix_sizes(documents(spark, rows)).collect()
    by_rate = collections.defaultdict(list)
    for r in got:
        if r.doc_id < 1000:
            by_rate[round(r.target / r.source_size, 6)].append(r.copies)
    assert len(by_rate) == 3
    for rate, copies in by_rate.items():
        share = rate - math.floor(rate)
        assert set(copies) <= {math.floor(rate), math.floor(rate) + 1}
        assert abs(sum(copies) / len(copies) - rate) <= 4 * math.sqrt(share * (1 - share) / len(copies)) + 1e-9


@pytest.mark.parametrize("bits", [0, 3, 10])
def test_mixing_is_systematic_along_sizes(spark, bits, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_BITS", bits)
    rows = [(i, prose(i, 1 + i % 9), None, "ab"[i % 5 == 0]) for i in range(600)] + [(7000, "x " * 900, None, "a"), (7001, None, None, "b")] + [(5, "same words", None, "a")] * 40
    got = mixing.mix_sizes(documents(spark, rows)).collect()
    again = mixing.mix_sizes(documents(spark, rows).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert len({r.copies for r in got if r.doc_id == 5 and r.size == 2}) == 1
    for target in {r.target for r in got}:
        own = [r for r in got if r.target == target]
        # Off by no more than the largest document, and the repeated rows, which go together.
        assert abs(sum(r.taken for r in own) - target) <= max(r.size for r in own) + 80


def test_language_id(spark):
    parts = {"x": ["ab", "ra", "ka"], "y": ["ulo", "mi", "tem"]}
    r = random.Random(3)
    rows = [(i, " ".join("".join(r.choice(parts[y]) for _ in range(3)) for _ in range(30)), y) for i, y in enumerate("xy" * 60)]
    rows += [(900, None, "x"), (901, "12 !?", "y"), (902, "", None), (None, rows[0][1], None), (903, rows[1][1] * 40, None)]
    docs = documents(spark, rows)
    model = langid.fit_on(docs, F.coalesce(F.col("doc_id") % 4 != 2, F.lit(False)))
    got = langid.identify(docs.select("doc_id", "text"), model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    named = {r.doc_id: r.lang_pred for r in got}
    assert all(named[i] == y for i, _, y in rows[:120]) and named[None] == "x" and named[903] == "y"


def test_languages_of_long_texts_only_are_learnt(spark):
    def text(words, seed, n):
        return " ".join(random.Random(seed).choice(words) for _ in range(n))

    x, y = ["abra", "kadabra", "bada"], ["simsel", "bim", "kippel"]
    rows = [(i, text(x, i, 40), "x") for i in range(20)] + [(100 + i, "1 " * 9000 + text(y, i, 3000), "y") for i in range(8)]
    docs = documents(spark, rows + [(200, text(y, 99, 30), None)])
    sample = langid.training_rows(docs, F.lit(True)).collect()
    assert len(sample) == 28 and all(re.search("[a-z]", r.text) and len(r.text) <= langid.ROW_CHARS for r in sample)
    named = {r.doc_id: r.lang_pred for r in langid.identify(docs, langid.fit_on(docs, F.lit(True))).collect()}
    assert all(named[i] == lang for i, _, lang in rows) and named[200] == "y"


def test_stage_without_labels_keeps_texts(spark):
    rows = [(1, "some words"), (2, None), (3, "12 !?"), (4, "\u00e9"), (None, "more words")]
    got = corpus_pipeline.language_id(spark, documents(spark, rows), "")
    assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "4", "None"]


def test_presence_kernel_equals_sets(spark):
    texts = ["abra kadabra", "Kadabra!! 7 abra", "simsala bim", "bim bam"]
    model = langid.fit(texts, ["p", "p", "q", "q"], landmarks=2)
    letters = langid.letter_table()
    grams = [{int(c) for n in (1, 2, 3) for c in langid.ngram_codes(langid.code_points(t, letters), n)} for t in texts]
    known = set(model.codes.tolist())
    for i, row in enumerate(model.kernel(texts)):
        for j, value in enumerate(row):
            a, b = grams[i] & known, grams[j] & known
            assert value == pytest.approx(len(a & b) / math.sqrt(len(a) * len(b)), rel=1e-5)


@pytest.mark.parametrize("dims", [3, 1500])
def test_nearest_neighbours_are_exact(spark, dims):
    g = np.random.default_rng(5)
    x = g.normal(size=(300, dims)).astype(np.float32)
    x[50:90] = x[50]  # ties
    x[200] *= 1000
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    bad = [(1000, None, 1), (1020, [0.0] * dims, 1), (1040, [float("nan")] * dims, 1), (1060, [None] * dims, 1), (None, x[0].tolist(), 1), (1080, [], 1)]
    table = spark.createDataFrame(rows + rows[:5] + bad, "vec_id long, embedding array<float>, rank int")
    got = collections.defaultdict(list)
    for r in ann.nearest(table, F.col("vec_id") % 20 == 0, k=10, block_rows=64).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    d = x.astype(float)
    for q in range(0, 300, 20):
        want = sorted((math.sqrt(((d[q] - d[j]) ** 2).sum()), j) for j in range(300) if j != q)[:10]
        assert [v for v, _ in got[q]] == [j for _, j in want]
        assert [s for _, s in got[q]] == pytest.approx([s for s, _ in want], rel=1e-12)
    assert set(got) == set(range(0, 300, 20))


@pytest.mark.parametrize("block", [8, 16384])
def test_an_id_with_many_vectors_takes_one_place(spark, block):
    g = np.random.default_rng(8)
    near = [(2, (0.01 * (i + 1), 0.0, 1.0)) for i in range(12)] + [(3, (0.02, 0.001 * i, 1.0)) for i in range(40)]
    rows = [(0, (0.0, 0.0, 1.0)), (0, (5.0, 5.0, 5.0)), *near, *[(10 + i, tuple(g.normal(size=3).tolist())) for i in range(30)]]
    table = spark.createDataFrame([(i, list(v)) for i, v in rows], "vec_id long, embedding array<double>").repartition(4)
    got = ann.nearest(table, F.col("vec_id") == 0, k=10, block_rows=block).orderBy("rank").collect()
    best = {}
    for i, v in rows:
        if i:
            d = min(math.dist(v, w) for j, w in rows if j == 0)
            best[i] = min(best.get(i, d), d)
    want = sorted((d, i) for i, d in best.items())[:10]
    assert [r.vec_id for r in got] == [i for _, i in want] and len(got) == 10
    assert [r.score for r in got] == pytest.approx([d for d, _ in want])


def test_features_that_share_a_slot_are_found(monkeypatch):
    monkeypatch.setattr(langid, "HASH_BITS", 3)
    codes = np.arange(100, 160, dtype=np.uint64) * np.uint64(7)
    model = langid.Model(["x"], codes, None, None, 3).prepare()
    asked = np.arange(600, 1200, dtype=np.uint64)
    want = [i for i, c in enumerate(codes.tolist()) if 600 <= c < 1200]
    assert sorted(model.features(asked).tolist()) == want


def test_chat_round_trip(spark):
    hard = '\\### <turn role="assistant"> </turn>\n \\< \\\\ "'
    rows = [(1, 0, "user", hard), (1, 1, "assistant", hard), (1, 2, None, None), (None, 0, "assistant", "x"), (2, 1, "assistant", "b"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (3, None, "us<er", "")]
    formatted = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.conversation_digests(formatted).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_parts(spark):
    part = dict.fromkeys(("type", "text", "ref", "width", "height", "seconds", "pages"))
    parts = [part | {"type": "text", "text": "see <b>"}, part | {"type": "image", "ref": "i.png", "width": 28, "height": 15}, part | {"type": "audio", "ref": "a", "seconds": 2.0}, part | {"type": "document", "pages": 3}]
    table = spark.createDataFrame([(1, 0, "assistant", parts)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    (r,) = chat.format_conversations(table).collect()
    assert r.formatted == '<turn role="assistant">see \\<b><image 1/><audio 2/><document 3/></turn>\n'
    assert [(a["kind"], a["ref"], a["tokens"]) for a in r.attachments] == [("image", "i.png", 4), ("audio", "a", 50), ("document", None, 3 * chat.TOKENS_A_PAGE)]
    assert all(r.formatted[a["at"] :].startswith(f"<{a['kind']}") for a in r.attachments)
    assert r.formatted[r.loss_start : r.loss_end].startswith("see") and r.tokens == 2 + 4 + 50 + 3 * chat.TOKENS_A_PAGE


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, v):
    d = re.sub("[^0-9]", "", v)
    if kind == "ip":
        return all(int(x) <= 255 for x in v.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind == "email" or 9 <= len(d) <= 15


def test_personal_data_patterns(spark):
    r = random.Random(11)
    alphabet = ["a", "Z", "@", ".", "-", "+", "%", "_", " ", "(", ")", "1", "0", "25", "4111 1111-1111 1111", "x@y.z", "+1 (555) 010-9999", "10.0.0.1", "é", "\n"]
    rows = [(i, "".join(r.choice(alphabet) for _ in range(r.randrange(1, 60)))) for i in range(1500)]
    rows += [(2000, None), (2001, ""), (None, "a@b.cd"), (2002, "7" * 50_000), (2003, "a" * 50_000 + "@b.c" + ".d" * 20_000), (2004, "+1" + " " * 50_000)]
    got = {x.doc_id: x for x in pii.digests(pii.find_private(documents(spark, rows))).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want = sorted((m.start(), k, kind, m.end()) for k, kind in enumerate(PLAIN) for m in re.finditer(PLAIN[kind], text or "") if valid(kind, m[0]))
        line = ",".join(f"{kind}:{s}:{e}" for s, _, kind, e in want)
        assert got[i].base_sha256 == hashlib.sha256(line.encode()).hexdigest(), text
        assert got[i].n_email == sum(w[2] == "email" for w in want)


def test_texts_of_very_many_matches_take_linear_time(spark):
    import time

    many = " ".join(f"a{i}@b{i % 7}.org" for i in range(16_000))
    rows = [(1, many), (2, "none"), (3, None), (4, ""), (5, "x@y.zz")]

    def run(of):
        return documents(spark, of).select("doc_id", F.explode(pii.located(F.coalesce("text", F.lit("")), pii.PATTERNS["email"])).alias("m")).select("doc_id", "m.*").collect()

    run(rows[1:])  # without the time to compile
    took = time.perf_counter()
    found = run(rows)
    took = time.perf_counter() - took
    want = [(1, m.start(), m.end(), m.group()) for m in re.finditer(r"\S+", many)] + [(5, 0, 6, "x@y.zz")]
    assert sorted((r.doc_id, r.s, r.e, r.v) for r in found) == want
    assert all(r.l == many[max(0, r.s - 1) : r.s] and r.r == many[r.e : r.e + 1] for r in found if r.doc_id == 1)
    assert took < 10


def test_disclosing_terms_are_found_and_cut(spark):
    rows = [(i, f"{prose(i, 30)} Quaxley writes from quax@corp.example today {prose(i + 50, 30)}".replace("w", "word")) for i in range(12)]
    rows += [(100 + i, prose(i, 60).replace("w", "word") + " today writes from") for i in range(200)]
    docs = documents(spark, rows)
    found = pii.find_private(docs)
    text = dict(rows)
    for r in found.filter("doc_id < 100").collect():
        assert "Quaxley" in {text[r.doc_id][t.s : t.e] for t in r.terms}
        assert "today" not in {text[r.doc_id][t.s : t.e] for t in r.terms}
    assert found.filter("doc_id >= 100 AND size(terms) > 0").count() == 0
    clean = docs.select("doc_id", "text").join(found.drop("row_key"), "doc_id").select("doc_id", pii.sanitise(F.col("text"), F.col("base"), F.col("terms")).alias("t"))
    for r in clean.filter("doc_id < 100").collect():
        assert "[EMAIL]" in r.t and "Quaxley" not in r.t and "corp" not in r.t


def test_terms_of_rare_values_are_found(spark):
    rows = [(i, prose(i, 60).replace("w", "word")) for i in range(200)]
    rows += [(300, f"{prose(300, 30)} zyxa Quaxley quax@corp.example {prose(301, 30)}"), (301, f"{prose(302, 30)} Brimbol 10.1.2.3 {prose(303, 30)}")]
    rows += [(302 + i, f"{prose(304 + i, 30)} Dorwick +1 555 010 9999 {prose(306 + i, 30)}") for i in range(2)]
    # One local name, but a different domain in each text.
    rows += [(310 + i, f"{prose(310 + i, 30)} Ermin ermin@host{i}.example {prose(320 + i, 30)}") for i in range(2)]
    text = dict(rows)
    found = {r.doc_id: {text[r.doc_id][t.s : t.e] for t in r.terms} for r in pii.find_private(documents(spark, rows)).collect()}
    assert {"zyxa", "Quaxley"} <= found[300] and "Brimbol" in found[301]
    assert all("Dorwick" in found[302 + i] and "Ermin" in found[310 + i] for i in range(2))
    assert not any(found[i] for i in range(200))


def test_flagged_terms_are_marked_wherever_they_stand(spark):
    rows = [(i, prose(i, 60)) for i in range(200)]
    rows += [(300, f"{prose(300, 30)} Quaxley jo_77 xq quax@corp.example {prose(301, 30)} QUAXLEY, xq {prose(302, 30)} (jo_77)")]
    rows += [(301, f"{prose(303, 30)} quaxley {prose(304, 30)} quaxleys")] * 2 + [(None, f"xq {prose(305, 30)} Jo_77"), (302, None)]
    found = pii.find_private(documents(spark, rows), disclosed=0.6).collect()
    text = dict(rows)
    assert len(found) == len(rows)
    marked = {r.doc_id: sorted(text[r.doc_id][t.s : t.e] for t in r.terms) for r in found}
    assert marked[300] == ["QUAXLEY", "Quaxley", "jo_77", "jo_77", "xq", "xq"]
    assert marked[301] == ["quaxley"] and marked[None] == ["Jo_77", "xq"] and marked[302] == []
    assert {t.action for r in found if r.doc_id == 301 for t in r.terms} == {"generalise"}


def test_toxicity(spark):
    r = random.Random(9)
    rows = [(i, prose(i, 60).replace("w", "word") + (f" {r.choice(['vile', 'foul'])} {r.choice(['vile', 'foul'])}" if i % 5 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(250)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    extra = [(900, None), (901, ""), (None, "vile foul")]
    docs = documents(spark, [(i, t.replace("0", "a").replace("1", "b")) if t else (i, t) for i, t in rows + extra])
    model = toxicity.fit(docs, labels, F.coalesce(F.col("doc_id") % 7 != 0, F.lit(False)))
    got = {x.doc_id: x for x in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    assert all((got[i].predicted == 1) == (i % 5 == 0) for i in range(300))
    assert got[None].predicted == 1 and got[900].predicted == got[901].predicted == 0
    assert all(0 <= x.score <= 1 for x in got.values()) and got[0].evidence


def test_toxicity_sample_holds_rows_with_texts(spark):
    rows = [(i, "good words here") for i in range(20)] + [(100 + i, "vile words " * 500) for i in range(20)] + [(200, ""), (201, None), (0, "good again")]
    labels = spark.createDataFrame([(i, int(i >= 100)) for i in [*range(20), *range(100, 120), 200, 201, *range(1000, 3000)]], "doc_id long, toxic int")
    model = toxicity.fit(documents(spark, rows), labels, F.lit(True), examples=40, chars=300)
    assert sorted(model.ids) == [*range(20), *range(100, 120)] and model.rate == 0.5


def test_block_max_search_is_exact():
    r = random.Random(4)
    vectors = []
    for _ in range(500):
        v = {t: r.random() for t in r.sample(range(40), r.randrange(0, 6))}
        n = math.sqrt(sum(w * w for w in v.values())) or 1
        vectors.append({t: w / n for t, w in v.items()})
    index = toxicity.Index(vectors, 40, block=16)
    for q in vectors[:80]:
        want = sorted((-sum(w * v.get(t, 0) for t, w in sorted(q.items())), i) for i, v in enumerate(vectors))
        want = [(round(-s, 9), i) for s, i in want if s < 0][:10]
        got = [(round(c, 9), i) for c, i in index.search(q, 10)]
        assert [s for s, _ in got] == [s for s, _ in want]


def test_deep_shallow_sort():
    g = np.random.default_rng(2)
    strings = g.integers(0, 2, (400, 60)).astype(np.uint8)
    strings[100:300] = strings[100]
    strings[150:300, 50:] = g.integers(0, 3, (150, 10))
    group = np.sort(g.integers(0, 7, 400))
    order, common = suffix_dedup.deep_shallow_sort(group, strings, shallow=16)
    keys = [(int(group[i]), strings[i].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(400))
    for k in range(1, 400):
        a, b = keys[k - 1], keys[k]
        n = next((j for j in range(60) if a[1][j] != b[1][j]), 60)
        assert common[k] == (n if a[0] == b[0] else -1)


@pytest.mark.parametrize("group_rows", [2, 50_000])
def test_repeated_passages(spark, group_rows):
    passage, line = prose(7, 40), "same line again and again\n"
    rows = [(i, prose(100 + i, 30) + passage[: 60 + 7 * i] + prose(200 + i, 20)) for i in range(20)]
    rows += [(50, line * 30), (51, "z" * 500), (52, None), (53, passage), (53, passage), (None, prose(300, 50)), (54, prose(301, 60)), (55, prose(301, 60) + "!"), (56, "é" * 80 + prose(100, 30))]
    length, span = 60, 32
    texts = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    want = []
    for (doc, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        gone = gone[:-1]
        spans = int((gone & ~np.concatenate(([False], gone[:-1]))[: len(gone)]).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        want.append((str(doc), len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    got = suffix_dedup.remove_repeats(documents(spark, rows), length, span, group_rows).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)


def test_minimum_bin_slack_is_closest():
    r = random.Random(6)
    for _ in range(60):
        counts = collections.Counter(r.randrange(1, 40) for _ in range(12))
        capacity = r.randrange(1, 90)
        items = list(counts.elements())
        sums = {0}
        for x in items:
            sums |= {s + x for s in sums if s + x <= capacity}
        chosen = packing._take(capacity, dict(counts))
        assert sum(chosen) == max(sums) and not collections.Counter(chosen) - counts


def test_packing(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    vocabulary = path("word_bpe_49k.json")
    odd = "It's  café é <|endoftext|>x 3⁄4 中文 \U0001f600\x0b\x85 A\r\nB"
    rows = [*[(i, prose(i, 20 + 13 * (i % 60))) for i in range(120)], (500, None), (501, ""), (502, odd * 3), (503, LONG), (503, LONG), (None, "x")]
    got = packing.pack(packing.token_pieces(documents(spark, rows), vocabulary), shard_pieces=40).collect()
    tokenizer = Tokenizer.from_file(vocabulary)
    want = collections.Counter()
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 2048):
            part = np.array(ids[s : s + 2048], "<u4").tobytes()
            want[(i, s, len(part) // 4, zlib.crc32(part), len(ids))] += 1
    assert collections.Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 2048


@pytest.mark.parametrize(("words", "num", "size", "members"), [(3, 90, 2_000_000, 8192), (3, 90, 400, 8192), (5, 80, 400, 8192), (5, 80, 2_000_000, 3)])
def test_similarity_components(spark, words, num, size, members):
    r = random.Random(8)
    rows = [(1, None), (2, ""), (3, "one two"), (4, "ONE  two"), (5, "one two three four"), (None, "one two"), (6, prose(1, 120)), (6, prose(1, 120))]
    for base in range(12):
        tokens = prose(50 + base, r.choice([8, 30, 90, 200])).split()
        for copy in range(r.choice([2, 5, 25])):
            t = list(tokens)
            for _ in range(r.randrange(0, 4)):
                t[r.randrange(len(t))] = f"e{r.randrange(30)}"
            rows.append((100 + 50 * base + copy, " ".join(t)))

    def shingles(text):
        w = (text or "").lower().split()
        return frozenset([tuple(w)] if 0 < len(w) < words else [tuple(w[i : i + words]) for i in range(len(w) - words + 1)])

    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= num * (len(sets[i]) + len(sets[j]) - n) and label[i] != label[j]:
                label = [label[j] if x == label[i] else x for x in label]
    want = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == label[i] and rows[k][0] is not None]
        want.append((str(doc), len(sets[i]), str(min(ids, default=None))))
    got = ngram_join.link_components(documents(spark, rows), words, num, 100, size, members).collect()
    assert sorted((str(x.doc_id), x.n_shingles, str(x.component_id)) for x in got) == sorted(want)


def test_keep_one_decides_by_row(spark):
    a, b, c, d = (prose(s, 100) for s in (31, 32, 33, 34))
    near = lambda t, k: f"{t} tail{k}"
    rows = [
        (1, a), (2, near(a, 1)), (None, near(a, 2)), (None, prose(35, 100)), (None, None), (3, ""),
        (2, b), (4, near(b, 1)),  # id 2 goes from the group of a and represents the group of b
        (1, c), (1, near(c, 1)),  # linked texts under one id
        (None, d), (None, near(d, 1)),  # no id at all
        (4, prose(36, 100)), (9, None),
    ]
    got = [(r.doc_id, r.text) for r in ngram_join.keep_one(documents(spark, rows)).collect()]
    assert len(got) == len(set(got)) and set(got) <= set(rows)
    assert set(rows) - set(got) >= {(2, near(a, 1)), (None, near(a, 2)), (4, near(b, 1))}
    assert {(1, a), (None, prose(35, 100)), (None, None), (3, ""), (2, b), (4, prose(36, 100)), (9, None)} <= set(got)
    assert len({(1, c), (1, near(c, 1))} & set(got)) == 1 and len({(None, d), (None, near(d, 1))} & set(got)) == 1


def test_document_ids_equal_the_tokenizer():
    import random

    import public_tokenizers
    import pyarrow as pa
    from tokenizers import Tokenizer

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, rng = Tokenizer.from_file(vocabulary), random.Random(3)
    assert packing.cut_pattern(tokenizer)
    alphabet = "aAbBsSdDtTmMlLvVeErR'’.,!?-0159 \n\t\r<|>&#éÉßÜñŒİıŸ²½ªº¡«×ΣςΩд漢かé́ĳŉǅſ\x85\xa0\xad　\x1c\x00​😀"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    texts += [f"x{chr(c)}Y" for c in range(0x800)] + ["a<|endoftext|>b", "<|ENDOFTEXT|> x", "", None, "word " * 3000]
    found = packing.document_ids(pa.array(texts, pa.large_string()), packing.WordIds(vocabulary), 1)
    for text, ids in zip(texts, found, strict=True):
        assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
