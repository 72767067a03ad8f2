"""Benchmark decontamination by a broadcast hash set of test n-grams.

A word is a maximal run of digits, letters A to Z (lowered) and characters above ASCII. A
window is ``WINDOW`` consecutive words of an item; an item of fewer words, but not none, is one
window. A document word inside any occurrence of a window is hit.

1. The windows of the benchmark are normalised to rows of word numbers, equal ones once, and
   hashed. Numbers, hashes and the items of each window travel as plain arrays in a broadcast of
   at most ``WINDOWS`` windows of items. A larger benchmark is cut into slices of that size; every
   slice scans the documents by itself and the spans found are united by row.
2. A scan lowers and splits a batch of texts at once, numbers their words by a look-up in the
   benchmark's vocabulary, hashes every window of known words, and looks it up: first in a
   bitmap of hash prefixes, then in the sorted hashes. Every hit is verified word by word.
3. Hits become spans of words and of bytes; :func:`decontaminate` cuts the spans out of the texts
   or drops the documents.

A scan is narrow: no document is shuffled. Memory is bounded by ``SLICE_BYTES`` of text, or one
text with four bytes a word. Python's work is a few array passes over the bytes.

Results for special rows: a null or empty text, or one without words, has no words and is not
contaminated; null, empty and wordless items have no window; rows of one item id are one item,
and all items with a null id are one, written as an empty text; item ids are compared as strings; a null
document id is carried through; repeated rows get equal results; an empty table, or an empty
benchmark, hits nothing; other columns are ignored, or kept by :func:`decontaminate`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, release_memory

WINDOW = 10
#: Windows of items in one broadcast, and the bytes a window has on average at most.
WINDOWS = 1 << 20
WINDOW_BYTES = 128
SLICE_BYTES = 4 << 20
FILTER_BITS = 22
#: A word, in texts lowered from A to Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

HIT_FIELDS = "n_words long, starts array<long>, ends array<long>, byte_starts array<long>, byte_ends array<long>, items array<string>"


def lowered_bytes() -> np.ndarray:
    """For each byte its lowered form, or a blank where it belongs to no word."""
    table = np.full(256, 32, np.uint8)
    for first, last in ((48, 57), (97, 122), (128, 255)):
        table[first : last + 1] = np.arange(first, last + 1)
    table[65:91] = np.arange(97, 123)
    return table


def words_of(raw: np.ndarray, table: np.ndarray, breaks: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of ``raw`` bytes with their places; none reaches over one of ``breaks``."""
    low = table[raw]
    inside = low != 32
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = breaks[(breaks > 0) & (breaks < len(raw))]
    edges = edges[inside[edges] & inside[edges - 1]]
    begins[edges], stops[edges - 1] = True, True
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(low[inside])])
    return words, starts, ends


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def window_hashes(ids: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of every row of word numbers."""
    h = np.full(len(ids), seed, np.uint64)
    for column in ids.T:
        h = mixed(h) + column.astype(np.uint64)
    return mixed(h)


def benchmark_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(words, item)``: the distinct windows of every item."""
    text = F.translate(F.coalesce("text", F.lit("")), *LETTERS)
    of_item = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.regexp_extract_all(text, F.lit(WORD), 0).alias("words"))
    count = F.size("words")
    last = F.greatest(count - window, F.lit(0))
    rows = of_item.filter(count > 0).select("item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("words", i + 1, window))).alias("words"))
    return rows.select("words", "item").distinct()


def packed(rows: list[tuple[list[str], str]]) -> dict:
    """Arrays that a scan needs for these windows of items; bytes and arrays only, so workers need no classes."""
    held: dict[tuple, list[str]] = {}
    for words, item in rows:
        held.setdefault(tuple(words), []).append(item)
    number = {w: i for i, w in enumerate(sorted({w for words in held for w in words}))}
    names = sorted({item for _, item in rows})
    place = {x: i for i, x in enumerate(names)}
    tables = []
    for length in sorted({len(words) for words in held}):
        own = [words for words in held if len(words) == length]
        ids = np.array([[number[w] for w in words] for words in own], np.int32)
        seed = 0
        while len(np.unique(hashes := window_hashes(ids, seed))) < len(own):  # a seed by which no two of these windows collide
            seed += 1
        order = np.argsort(hashes)
        bitmap = np.zeros(1 << FILTER_BITS, bool)
        bitmap[hashes >> np.uint64(64 - FILTER_BITS)] = True
        items = [held[own[i]] for i in order.tolist()]
        tables.append(
            {
                "length": length, "seed": seed, "hashes": hashes[order], "ids": ids[order], "bitmap": np.packbits(bitmap),
                "item_at": np.concatenate(([0], np.cumsum([len(x) for x in items]))), "item": np.array([place[i] for x in items for i in x], np.int64),
            }
        )
    return {"vocabulary": [w.encode() for w in number], "names": names, "tables": tables}


class Scanner:
    """Finds the windows of a broadcast in batches of texts."""

    def __init__(self, windows: dict):
        self.names, self.table = windows["names"], lowered_bytes()
        self.vocabulary = pa.array(windows["vocabulary"], pa.binary())
        self.tables = [t | {"bitmap": np.unpackbits(t["bitmap"]).view(bool)} for t in windows["tables"]]

    def numbered(self, raw: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers (-1: not in the benchmark) and places, ``SLICE_BYTES`` at a time."""
        ids, starts, ends, at = [], [], [], 0
        while at < len(raw):
            to = min(len(raw), at + SLICE_BYTES)
            while to < len(raw):  # on to the next separator: words stay whole
                stop = np.flatnonzero(self.table[raw[to : to + SLICE_BYTES]] == 32)
                to = min(len(raw), to + (int(stop[0]) if len(stop) else SLICE_BYTES))
                if len(stop):
                    break
            words, s, e = words_of(raw[at:to], self.table, breaks - at)
            found = pc.index_in(words, value_set=self.vocabulary) if len(self.vocabulary) else pa.nulls(len(words), pa.int32())
            ids.append(pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int32))
            starts.append(s + at)
            ends.append(e + at)
            at = to
        none = [np.empty(0, np.int64)]
        return np.concatenate(ids or none).astype(np.int32), np.concatenate(starts or none), np.concatenate(ends or none)

    def matches(self, ids: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, dict]]:
        """Verified ``(word position, window)`` pairs a length; ``first[i]`` is the first word of word i's text."""
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        for t in self.tables:
            n = t["length"]
            if len(ids) < n:
                continue
            whole = (known[n:] - known[:-n] == n) & (first[n - 1 :] <= np.arange(len(ids) - n + 1))
            at = np.flatnonzero(whole)
            if not len(at):
                continue
            near = ids[at[:, None] + np.arange(n)]
            h = window_hashes(near, t["seed"])
            likely = t["bitmap"][h >> np.uint64(64 - FILTER_BITS)]
            at, near, h = at[likely], near[likely], h[likely]
            place = np.searchsorted(t["hashes"], h)
            place[place == len(t["hashes"])] = 0
            same = t["hashes"][place] == h
            at, near, place = at[same], near[same], place[same]
            if len(at):
                true = (near == t["ids"][place]).all(axis=1)
                yield at[true], place[true], t

    def scan(self, texts: pa.Array) -> list[tuple]:
        """Per text: words, starts and ends of hit spans in words and in bytes, and the items found."""
        n = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
        bounds = offsets - offsets[0]
        ids, starts, ends = self.numbered(raw, bounds)
        word_at = np.searchsorted(starts, bounds)  # the first word of each text, and the end
        first = np.repeat(word_at[:-1], np.diff(word_at))
        edge = np.zeros(len(ids) + 1, np.int64)
        pairs = []
        for at, place, t in self.matches(ids, first):
            np.add.at(edge, at, 1)
            np.add.at(edge, at + t["length"], -1)
            text = np.searchsorted(word_at, at, side="right") - 1
            taken = np.diff(t["item_at"])[place]
            reach = np.concatenate(([0], np.cumsum(taken)))
            item = t["item"][np.repeat(t["item_at"][:-1][place] - reach[:-1], taken) + np.arange(reach[-1])]
            pairs.append(np.stack((np.repeat(text, taken), item), axis=1))
        hit = np.cumsum(edge[:-1]) > 0
        # A span ends at its text's end: windows do not cross it, but the next text may begin with a hit.
        begin = hit.copy()
        begin[1:] &= ~hit[:-1] | (first[1:] != first[:-1])
        stop = hit.copy()
        stop[:-1] &= ~hit[1:] | (first[1:] != first[:-1])
        b, e = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        span_at = np.searchsorted(b, word_at)
        found: dict[int, list[str]] = {}
        if pairs:
            for text, item in np.unique(np.concatenate(pairs), axis=0).tolist():
                found.setdefault(text, []).append(self.names[item])
        out = []
        for i in range(n):
            own = slice(span_at[i], span_at[i + 1])
            s, f = b[own], e[own]
            out.append((int(word_at[i + 1] - word_at[i]), s - word_at[i], f - word_at[i], starts[s] - bounds[i], ends[f - 1] - bounds[i], sorted(found.get(i, []))))
        return out


def text_slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Parts of about ``SLICE_BYTES``, or one text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES, prepend=-1)) if len(texts) else []
    for at, to in zip(starts, [*starts[1:], len(texts)]):
        yield pc.fill_null(texts.slice(at, to - at), "")


def _scan(docs: DataFrame, windows: dict, only_hits: bool = False) -> DataFrame:
    """``docs`` with ``HIT_FIELDS`` in place of ``text``."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)
    kept = [c for c in docs.columns if c != "text"]
    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.select(*kept).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(shared.value)
        long_list, text_list = pa.list_(pa.int64()), pa.list_(pa.string())
        for batch in batches:
            at = 0
            for texts in text_slices(batch.column("text").cast(pa.large_string())):
                rows = scanner.scan(texts)
                keep = [i for i, r in enumerate(rows) if len(r[1])] if only_hits else range(len(rows))
                part = batch.select(kept).slice(at, len(texts)).take(pa.array(keep, pa.int64()))
                columns = [pa.array([rows[i][0] for i in keep], pa.int64())]
                columns += [pa.array([rows[i][k] for i in keep], long_list) for k in range(1, 5)]
                columns.append(pa.array([rows[i][5] for i in keep], text_list))
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*kept, "n_words", "starts", "ends", "byte_starts", "byte_ends", "items"])
                at += len(texts)
        release_memory()

    return docs.mapInArrow(run, f"{kinds}, {HIT_FIELDS}" if kept else HIT_FIELDS)


def united(starts: list[int], ends: list[int], byte_starts: list[int], byte_ends: list[int]) -> tuple[list[int], ...]:
    """Spans sorted, overlapping and touching ones as one."""
    out: list[list[int]] = []
    for s, e, bs, be in sorted(zip(starts, ends, byte_starts, byte_ends)):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1][1], out[-1][3] = e, be
        else:
            out.append([s, e, bs, be])
    return tuple([x[k] for x in out] for k in range(4))


def _unite(hits: DataFrame) -> DataFrame:
    """One row of spans and items a ``__row`` of the hits found with several slices."""
    fields = ["starts", "ends", "byte_starts", "byte_ends"]
    lists = hits.groupBy("__row").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in fields], F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [united(*x) for x in zip(*[batch.column(c).to_pylist() for c in fields])]
            columns = [pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column("__row"), *columns, batch.column("items")], names=["__hit", *fields, "items"])

    return lists.mapInArrow(run, "__hit long, starts array<long>, ends array<long>, byte_starts array<long>, byte_ends array<long>, items array<string>")


def find_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, windows: int = WINDOWS) -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``HIT_FIELDS``: the words of a text, the spans of hit
    words (ends exclusive) as word and as byte positions, and the ids of the items found.

    ``docs`` has no columns of those names.
    """
    rows = cut(benchmark_windows(items, window))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.concat_ws(" ", "words")) + F.octet_length("item")).alias("bytes")).first()
    slices = max(1, -(-size["n"] // windows), -(-(size["bytes"] or 0) // (windows * WINDOW_BYTES)))
    if slices == 1:
        return _scan(docs, packed([(r["words"], r["item"]) for r in rows.orderBy("words", "item").collect()]))
    # Slices of the benchmark, each within the bound of a broadcast, and one scan for each.
    place = F.floor((F.row_number().over(Window.partitionBy("part").orderBy("words", "item")) - 1) / windows)
    dealt = cut(rows.withColumn("part", F.pmod(F.xxhash64("words", "item"), F.lit(slices))).withColumn("piece", place))
    docs = cut(docs.withColumn("__row", F.monotonically_increasing_id()))
    hits = None
    for key in dealt.select("part", "piece").distinct().orderBy("part", "piece").collect():
        own = dealt.filter((F.col("part") == key["part"]) & (F.col("piece") == key["piece"])).orderBy("words", "item").collect()
        found = cut(_scan(docs.select("__row", "text"), packed([(r["words"], r["item"]) for r in own]), only_hits=True))
        hits = found if hits is None else hits.unionByName(found)
    counted = _scan(docs, packed([])).drop("starts", "ends", "byte_starts", "byte_ends", "items")
    out = counted.join(_unite(hits), F.col("__row") == F.col("__hit"), "left").drop("__row", "__hit")
    empty = {c: F.coalesce(c, F.array().cast("array<long>")) for c in ("starts", "ends", "byte_starts", "byte_ends")}
    out = out.withColumns(empty | {"items": F.coalesce("items", F.array().cast("array<string>"))})
    return out.select(*[c for c in docs.columns if c not in ("text", "__row")], "n_words", "starts", "ends", "byte_starts", "byte_ends", "items")


def hit_words():
    """Number of hit words of a row of :func:`find_leaks`."""
    return F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)


def leak_report(docs: DataFrame, items: DataFrame, window: int = WINDOW, windows: int = WINDOWS) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` for every row of ``docs``."""
    found = find_leaks(docs.select("doc_id", "text"), items, window, windows)
    return found.select(
        "doc_id", "n_words", hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "spans", window: int = WINDOW, windows: int = WINDOWS) -> DataFrame:
    """``docs`` without the contaminated documents, or with the hit spans cut out of their texts."""
    if remove not in ("spans", "documents"):
        raise ValueError("remove is 'spans' or 'documents'")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = find_leaks(docs.select(row, "text"), items, window, windows)
    if remove == "documents":
        return found.filter(F.size("starts") == 0).select("row.*")
    raw = F.col("row.text").cast("binary")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.col("byte_ends"))
    ends = F.concat(F.col("byte_starts"), F.array(F.octet_length("row.text").cast("long")))
    kept = F.zip_with(starts, ends, lambda s, e: F.substring(raw, (s + 1).cast("int"), (e - s).cast("int")).cast("string"))
    text = F.when(F.size("starts") > 0, F.array_join(kept, "")).otherwise(F.col("row.text"))
    return found.select("row", text.alias("clean")).select(*[F.col("clean").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


LEAK_SQL = r"""
WITH b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
i AS (SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS win
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM b WHERE len(w) > 0)),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
p AS (SELECT r, k, m, array_to_string(w[k:k + m - 1], ' ') AS win
      FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS k FROM d), (SELECT DISTINCT m FROM i) WHERE k + m - 1 <= len(w)),
h AS (SELECT p.r, p.k, p.m, i.item FROM p JOIN i USING (m, win)),
n AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(k, k + m)) AS pos FROM h) GROUP BY r),
g AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN g USING (r)
"""
