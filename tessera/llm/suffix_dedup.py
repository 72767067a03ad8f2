"""Repeated passages by deep-shallow suffix sorting.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else is removed.
A start is repeated exactly if its string is, so the work is to sort the strings of all
starts, and to do that only where a repeat is possible:

1. Anchors. Each start belongs to an anchor, the position of the smallest hash of ``GRAM``
   bytes among the next ``SPAN`` positions. Equal strings have their anchor at the same place,
   so equal starts share the bytes from the anchor to the nearest end, the core. One row of
   two integers an anchor is shuffled; anchors whose core occurs once are dropped. Equal texts
   are detected as such and only one of them goes further, so copies cost one row each.
2. Groups. Live anchors bring the bytes around them, ``LENGTH`` to the right and up to
   ``SPAN`` to the left, to the group of their core. The strings to the right, and those to the
   left read backwards, are sorted deep-shallow: multikey quicksort on eight bytes at a time
   to a shallow depth, for all groups of a batch at once, and blind tries for the groups that
   still agree there. Neighbours' common lengths give, for any depth, the class of
   strings that agree so far; a start is repeated if another anchor of the group is in its
   class to the left and to the right.
3. Groups above ``GROUP_ROWS`` are not sorted in one task: their starts are grouped by the full
   string in a Spark aggregation, combined map-side.

Results for special rows: a null text is empty; texts shorter than ``LENGTH`` bytes lose
nothing; a null id is an ordinary value; a row repeated with the same id and text is a
further document, so all its bytes occur elsewhere; overlapping repeats inside one text
count; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, same, text_bytes
from .ngram_join import mix

LENGTH = 200
SPAN = 128  # a power of two
GRAM = 16
GROUP_ROWS = 50_000
BATCH_ROWS = 20_000
SHALLOW = 32


def words_at(body: np.ndarray) -> np.ndarray:
    """The eight bytes from every position, as one integer."""
    out = np.empty(len(body) - 7, np.uint64)
    for j in range(8):
        part = np.frombuffer(body, "<u8", (len(body) - j) // 8, j)
        out[j::8] = part
    return out


def anchors(body: np.ndarray, length: int, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, the first and last start of each, and the hash of each core."""
    starts = len(body) - length + 1
    if starts <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    w = words_at(body)
    h = mix(w[: starts + span - 1] * np.uint64(0x9E3779B97F4A7C15) + w[8 : starts + span + 7])
    h = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    step = 1
    while step < span:  # smallest of 2, 4, ... span positions; ties go to the left
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    at = (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    last = np.append(first[1:], starts) - 1
    at = at[first]
    core = length - span + 1
    key = np.full(len(at), core, np.uint64)
    for j in [*range(0, core - 7, 8), core - 8]:
        key = mix(key + w[at + j]) ^ key
    return at, first, last, key


def _check(length: int, span: int) -> None:
    if span & (span - 1) or length - span + 1 < GRAM:
        raise ValueError("span must be a power of two, and length at least span + 15")


class BlindTrie:
    """Orders strings of equal length, given as integers, by branching on differing bits."""

    def __init__(self, bits: int):
        self.bits, self.root = bits, None

    def add(self, value: int, item: int) -> None:
        if self.root is None:
            self.root = [value, [item]]
            return
        node = self.root
        while len(node) == 3:
            node = node[1 + (value >> node[0] & 1)]
        apart = (value ^ node[0]).bit_length() - 1
        if apart < 0:
            node[1].append(item)
            return
        parent, node, side = None, self.root, 0
        while len(node) == 3 and node[0] > apart:
            parent, side = node, 1 + (value >> node[0] & 1)
            node = parent[side]
        leaf = [value, [item]]
        branch = [apart, leaf, node] if not value >> apart & 1 else [apart, node, leaf]
        if parent is None:
            self.root = branch
        else:
            parent[side] = branch

    def ordered(self) -> list[int]:
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if len(node) == 3:
                stack += [node[2], node[1]]
            else:
                out += node[1]
        return out


def deep_shallow_sort(group: np.ndarray, strings: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows by (group, string), and common length with the row before (-1 at a group's start).

    ``group`` is non-decreasing; ``strings`` is a byte matrix.
    """
    n, width = strings.shape
    order = np.arange(n)
    segment = group.astype(np.int64)
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = strings
    words = padded.view(">u8").astype(np.uint64)
    for k in range(min(shallow // 8, words.shape[1])):
        # Three-way partition of all unresolved segments by the next eight bytes.
        same_before = np.concatenate(([False], segment[1:] == segment[:-1]))
        open_ = np.flatnonzero(same_before | np.append(same_before[1:], False))
        if not len(open_):
            break
        key = words[order[open_], k]
        turn = np.lexsort((key, segment[open_]))
        order[open_] = order[open_][turn]
        key = key[turn]
        breaks = np.zeros(n, np.int64)
        breaks[open_[1:]] = (key[1:] != key[:-1]) | (open_[1:] != open_[:-1] + 1)
        segment = np.cumsum(breaks + np.concatenate(([0], segment[1:] != segment[:-1]))) if n else segment
    edge = np.concatenate(([0], np.flatnonzero(segment[1:] != segment[:-1]) + 1, [n])) if n else np.array([0])
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b - a > 1:
            trie = BlindTrie(width * 8)
            rows = order[a:b]
            for i in rows.tolist():
                trie.add(int.from_bytes(strings[i].tobytes(), "big"), i)
            order[a:b] = trie.ordered()
    common = np.full(n, -1, np.int64)
    if n > 1:
        differ = strings[order[1:]] != strings[order[:-1]]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        common[1:][group[order[1:]] != group[order[:-1]]] = -1
    return order, common


def repeated_starts(group: np.ndarray, offset: np.ndarray, texts: list[bytes], length: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last repeated start of each row, relative to its bytes; -1 if there is none.

    A row is an anchor: its starts are ``0 .. len(bytes) - length`` and the anchor is at
    ``offset``; two starts are compared if their rows share the group and their distance
    to the anchor is the same.
    """
    n = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    right, left = np.zeros((n, length), np.uint8), np.zeros((n, span - 1), np.uint8)
    for i, t in enumerate(texts):
        a, o = np.frombuffer(t, np.uint8), int(offset[i])
        right[i, : len(t) - o] = a[o : o + length]
        left[i, :o] = a[:o][::-1]
    right_order, right_common = deep_shallow_sort(group, right)
    left_order, left_common = deep_shallow_sort(group, left)
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    nearest, farthest = offset - (sizes - length), offset  # distances from start to anchor
    to_right, to_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(span):
        rows = np.flatnonzero((nearest <= d) & (d <= farthest))
        if len(rows) < 2:
            continue
        to_right[right_order] = np.cumsum(right_common < length - d)
        to_left[left_order] = np.cumsum(left_common < d)
        code = to_right[rows] * (n + 1) + to_left[rows]
        turn = np.argsort(code, kind="stable")
        sorted_code = code[turn]
        equal = sorted_code[1:] == sorted_code[:-1]
        found = rows[turn[np.concatenate(([False], equal)) | np.append(equal, False)]]
        start = offset[found] - d
        high[found] = np.where(high[found] < 0, start, high[found])
        low[found] = start  # d rises, so starts fall
    return low, high


def _texts(docs: DataFrame) -> DataFrame:
    body = text_bytes(F.col("text"))
    return docs.select("doc_id", body.alias("body"), F.unhex(F.sha2(body, 256)).alias("sha"), F.xxhash64(body).alias("th"))


def _cores(texts: DataFrame, length: int, span: int) -> DataFrame:
    """``(th, key, twice)``: the cores of a text, and whether the text holds one more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            th, bodies = batch.column("th").to_numpy(), batch.column("body")
            for at in range(0, batch.num_rows, 512):
                parts = [], [], []
                for i in range(at, min(at + 512, batch.num_rows)):
                    key, n = np.unique(anchors(np.frombuffer(bodies[i].as_buffer(), np.uint8), length, span)[3], return_counts=True)
                    for part, values in zip(parts, (np.full(len(key), th[i]), key.view(np.int64), n > 1)):
                        part.append(values)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(p)) for p in parts], names=["th", "key", "twice"])

    return texts.select("th", "body").mapInArrow(run, "th long, key long, twice boolean")


def _records(texts: DataFrame, length: int, span: int) -> DataFrame:
    """Bytes around the live anchors of ``texts(sha, body, keys, hot_keys)``.

    A record of a hot key is the string of one start.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shas, bodies = batch.column("sha").to_pylist(), batch.column("body")
            for row in range(batch.num_rows):
                body = bodies[row].as_py()
                at, first, last, key = anchors(np.frombuffer(body, np.uint8), length, span)
                key = key.view(np.int64)
                hot = np.isin(key, batch.column("hot_keys")[row].values.to_numpy())
                live = hot | np.isin(key, batch.column("keys")[row].values.to_numpy())
                # Equal records of one text are one row with all their places.
                found: dict[tuple, list[int]] = {}
                for i in np.flatnonzero(live).tolist():
                    k, a, f, z = int(key[i]), int(at[i]), int(first[i]), int(last[i])
                    if hot[i]:
                        for s in range(f, z + 1):
                            found.setdefault((k, a - s, body[s : s + length], True), []).append(s)
                    else:
                        found.setdefault((k, a - f, body[f : z + length], False), []).append(f)
                out = [(*record, starts) for record, starts in found.items()]
                for start in range(0, len(out), 4096):
                    part = out[start : start + 4096]
                    columns = [pa.array([r[j] for r in part], t) for j, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.bool_(), pa.list_(pa.int64())))]
                    columns.append(pa.array([shas[row]] * len(part), pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "offset", "bytes", "hot", "starts", "sha"])

    return texts.mapInArrow(run, "key long, offset int, bytes binary, hot boolean, starts array<long>, sha binary")


def _ranges_of_groups(records: DataFrame, length: int, span: int) -> DataFrame:
    """``(sha, low, high)``: byte ranges to remove, from records with the rows of a key together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            key = rows.column("key").to_numpy()
            group = np.cumsum(np.concatenate(([0], key[1:] != key[:-1]))) if len(key) else key
            offset, texts = rows.column("offset").to_numpy().astype(np.int64), rows.column("bytes").to_pylist()
            low, high = repeated_starts(group, offset, texts, length, span)
            shas, out = rows.column("sha").to_pylist(), ([], [], [])
            for i, starts in enumerate(rows.column("starts").to_pylist()):
                a, b = (0, len(texts[i]) - length) if len(starts) > 1 else (int(low[i]), int(high[i]))
                for start in starts if a >= 0 else []:
                    for column, value in zip(out, (shas[i], start + a, start + b + length)):
                        column.append(value)
            kinds = (pa.binary(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=["sha", "low", "high"])

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                held.append(batch.slice(at, BATCH_ROWS))
                if sum(b.num_rows for b in held) < BATCH_ROWS:
                    continue
                table = pa.Table.from_batches(held)
                key = table.column("key").to_numpy()
                end = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
                held = table.slice(end).to_batches()
                if end:
                    yield done(table.slice(0, end))
        if held:
            yield done(pa.Table.from_batches(held))

    rows = records.repartition("key").sortWithinPartitions("key")
    return rows.mapInArrow(run, "sha binary, low long, high long")


def _cut_out(texts: DataFrame, length: int) -> DataFrame:
    """Remove ``ranges`` (or everything, for ``copies`` above 1) from ``texts``."""
    id_type = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column("body")
            out = [[] for _ in range(5)]
            for i, (ranges, copies) in enumerate(zip(batch.column("ranges").to_pylist(), batch.column("copies").to_pylist())):
                body = bodies[i].as_py()
                spans: list[list[int]] = []
                if copies > 1 and len(body) >= length:
                    spans = [[0, len(body)]]
                else:
                    for r in sorted((r["low"], r["high"]) for r in ranges or []):
                        if spans and r[0] <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], r[1])
                        else:
                            spans.append(list(r))
                at, kept = 0, hashlib.sha256()
                for a, b in spans:
                    kept.update(body[at:a])
                    at = b
                kept.update(body[at:])
                for column, value in zip(out, (len(body), sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [{"low": a, "high": b} for a, b in spans])):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, t) for c, t in zip(out, kinds)]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
            )

    return texts.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<low:bigint,high:bigint>>")


def remove_repeats(docs: DataFrame, length: int = LENGTH, span: int = SPAN, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the removed byte ``spans``."""
    _check(length, span)
    texts = _texts(docs)
    cores = _cores(texts, length, span).repartition("key")
    counts = cores.groupBy("key").agg(F.min("th").alias("lo"), F.max("th").alias("hi"), F.max("twice").alias("twice"), F.count(F.lit(1)).alias("n"))
    live = counts.filter("lo < hi OR twice").select("key", (F.col("n") > group_rows).alias("hot"))
    # Counting and joining use the same columns, and so the same shuffle.
    lists = cores.join(live, "key").groupBy("th").agg(
        F.collect_set(F.when(~F.col("hot"), F.col("key"))).alias("keys"),
        F.collect_set(F.when(F.col("hot"), F.col("key"))).alias("hot_keys"),
        F.count_if("twice").alias("twice"),
    )
    copies = cut(texts.select("sha", "th", "doc_id").groupBy("sha", "th").agg(F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("rep")))
    chosen = cut(copies.join(lists, "th").select(F.col("sha").alias("c_sha"), "rep", "keys", "hot_keys", "twice"))
    one_each = texts.join(chosen, (F.col("sha") == F.col("c_sha")) & same(F.col("doc_id"), F.col("rep")))
    records = _records(one_each.select("sha", "body", "keys", "hot_keys"), length, span)

    ranges = _ranges_of_groups(records.filter("NOT hot").drop("hot"), length, span)
    ranges = cut(ranges.groupBy("sha").agg(F.collect_list(F.struct("low", "high")).alias("ranges")))
    if not chosen.filter(F.size("hot_keys") > 0).isEmpty():
        starts = cut(records.filter("hot").select("sha", "starts", "bytes"))
        twice = starts.groupBy("bytes").agg(F.sum(F.size("starts")).alias("n")).filter("n > 1").select("bytes")
        more = starts.join(twice, "bytes").select("sha", F.explode("starts").alias("low")).withColumn("high", F.col("low") + length)
        every = ranges.select("sha", F.inline("ranges")).unionByName(more)
        ranges = cut(every.groupBy("sha").agg(F.collect_list(F.struct("low", "high")).alias("ranges")))
    ranges = copies.filter("copies > 1").select("sha", "copies").join(ranges, "sha", "full_outer").withColumnRenamed("sha", "r_sha")
    joined = texts.join(ranges, F.col("sha") == F.col("r_sha"), "left")
    return _cut_out(joined.select("doc_id", "body", "ranges", F.coalesce("copies", F.lit(1)).alias("copies")), length)
