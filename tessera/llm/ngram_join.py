"""Similarity join on word n-grams with a token-group matrix.

Two texts link when the Jaccard similarity of their sets of word shingles reaches the
threshold (``num / den``, compared in integers). The result is exact; the steps are:

1. Tokens. Sets of similar size share a scheme that splits the shingle space into parts. A
   part's content, hashed, is a token. Sets that differ in at most ``t`` shingles agree on all
   but ``t`` of the non-empty parts of either, which bounds their overlap in tokens from below.
   Tokens of a single text are dropped, and then texts with fewer tokens left than the bound.
2. Groups. Every distinct set goes to the group of its smallest live token, and groups that
   share a token move to the smallest of theirs, so similar texts mostly meet; groups of more
   than ``GROUP_SHINGLES`` shingles or ``GROUP_MEMBERS`` sets are split into blocks, which
   bounds a task's matrices. Each group is joined by itself: the
   shingles that several members hold form a 0/1 matrix, and its product with itself, in
   tiles, gives all overlaps.
3. Matrix. A text that shares at least ``least`` of its tokens with any linked text shares one
   of all but its ``least - 1`` most frequent ones; only those are looked up. Each group's union
   of them is stored as (token, group) pairs. First one member a
   pair is compared across the groups of a token, which merges the groups of most copies.
   Then every text is looked up: a group is opened for it if they share a token
   and the group is not already known to be in the text's component. A token of more than
   ``OPEN_GROUPS`` groups opens none: its texts are gathered and joined like a group, so
   what is looked up grows with the tokens, not with texts times groups.
4. Components of the links found, as labels that shrink to the smallest.

Equal sets are one node throughout, so copies cost one row. A node's id is a 64-bit hash of
its set, and shingles are compared by 64-bit hashes.

Results for special rows: a null text, or one without words, has no shingles and links with
nothing; a text with fewer words than a shingle has its whole sequence as one shingle; a
null id is a row of its own, and takes no part in the smallest id; repeated rows get equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, cut, release_memory, release_shuffles, same, small_batches

TOKEN_PASSES = 2
GROUP_SHINGLES = 2_000_000
GROUP_MEMBERS = 8192
OPEN_GROUPS = 4
TILE = 512
SLICE = 32
BATCH = 500
COLUMNS = 1024
CACHE_WORDS = 200_000


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit shingle hashes of a text."""

    def __init__(self, words: int):
        import xxhash

        self.words, self.hash, self.known = words, xxhash.xxh64_intdigest, {}

    def __call__(self, text: str | None) -> np.ndarray:
        # bytes.lower() changes A-Z only; bytes.split() splits at ASCII white space only.
        words = (text or "").encode("utf-8", "replace").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.words:
            return np.array([self.hash(b" ".join(words), len(words))], np.uint64)
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = self.hash(w)
        h = np.array([known[w] for w in words], np.uint64)
        m = len(h) - self.words + 1
        out = h[:m].copy()
        for k in range(1, self.words):
            out = mix(out) + h[k : k + m]
        return np.unique(mix(out))


class Schemes:
    """Which sizes share a scheme, its parts, and how many parts can differ."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.ends, self.cuts = num, den, [0], {}

    def level(self, size: int) -> int:
        """Level of a size: level ``j`` holds the sizes above ``ends[j - 1]`` up to ``ends[j]``."""
        while self.ends[-1] < size:
            self.ends.append((self.ends[-1] + 1) * self.den // self.num)
        return int(np.searchsorted(self.ends, size))

    def most_apart(self, a: int, b: int) -> int:
        """Most shingles in which linked sets of these sizes can differ."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def inner_edges(self, parts: int) -> np.ndarray:
        """Where the hash space is split into ``parts`` equal parts."""
        if parts not in self.cuts:
            self.cuts[parts] = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
        return self.cuts[parts]

    def tokens(self, s: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Tokens of both schemes of a set, the scheme's parity in the lowest bit, and for each
        parity how many of them any linked set shares at least."""
        size = len(s)
        level, largest = self.level(size), size * self.den // self.num
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(s ^ np.uint64(0x5851F42D4C957F2D)))))
        out, least = [], [1, 1]
        for j in (level, level + 1):
            while len(self.ends) <= j:
                self.level(self.ends[-1] + 1)
            end = self.ends[j]
            t = self.most_apart(end, end)
            parts = 1 if t == 0 else t + 2
            bounds = np.concatenate((np.zeros(1, np.int64), np.searchsorted(s, self.inner_edges(parts)), np.array([size])))
            content = sums[bounds[1:]] - sums[bounds[:-1]]
            filled = bounds[1:] > bounds[:-1]
            apart = self.most_apart(size, min(end, largest))
            index = np.arange(parts, dtype=np.uint64)
            token = mix(content + mix(index + np.uint64(j << 32) + np.uint64(1)))
            token = (token & ~np.uint64(1)) | np.uint64(j & 1)
            if filled.sum() > apart:
                out.append(token[filled])
                least[j & 1] = int(filled.sum()) - apart
            else:  # too few non-empty parts to be sure of a common one: empty parts count too
                out.append(token)
        return np.unique(np.concatenate(out)), least


def in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``BATCH`` rows at a time: the shingles of a batch take more memory than its texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield batch.slice(at, BATCH)


def features(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``(doc_id, row_key, n_shingles, node, tokens, least)`` for every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row_key"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, schemes = Shingler(words), Schemes(num, den)
        for batch in in_slices(batches):
            sizes, nodes, tokens, least = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text)
                sizes.append(len(s))
                if len(s):
                    nodes.append(int(mix(np.sum(mix(s + np.uint64(len(s))), dtype=np.uint64, keepdims=True)).view(np.int64)[0]))
                    own, shared = schemes.tokens(s)
                    tokens.append(own.view(np.int64))
                    least.append(shared)
                else:
                    nodes.append(None)
                    tokens.append(np.empty(0, np.int64))
                    least.append([1, 1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row_key"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(tokens, pa.list_(pa.int64())), pa.array(least, pa.list_(pa.int64()))],
                names=["doc_id", "row_key", "n_shingles", "node", "tokens", "least"],
            )
        release_memory()

    return rows.mapInArrow(run, "doc_id long, row_key long, n_shingles long, node long, tokens array<long>, least array<long>")


def shingled(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """Batches with the column ``shingles`` in place of each ``text``; texts are a third of their sets' size to move."""
    shingles = Shingler(words)
    for batch in in_slices(batches):
        columns = [
            pa.array([shingles(t).view(np.int64) for t in batch.column(n).to_pylist()], pa.list_(pa.int64())) if n.startswith("text") else batch.column(n)
            for n in batch.schema.names
        ]
        yield pa.RecordBatch.from_arrays(columns, names=[n.replace("text", "shingles") for n in batch.schema.names])


def linked(a: frozenset, b: frozenset, num: int, den: int) -> bool:
    if min(len(a), len(b)) * den < max(len(a), len(b)) * num:
        return False
    common = len(a & b)
    return common * den >= (len(a) + len(b) - common) * num


class Members:
    """The sets of a group, as a matrix over the shingles worth counting."""

    def __init__(self, sets: list[np.ndarray], least: int):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        kept = counts >= least
        column = np.where(kept, np.cumsum(kept) - 1, -1).astype(np.int32)[inverse]
        row = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        self.values = values[kept]
        self.row, self.column = _by_column(row[column >= 0], column[column >= 0])

    def overlaps(self, row: np.ndarray, column: np.ndarray, n: int) -> np.ndarray:
        """Common shingles of ``n`` sets, given by sorted columns, with every member."""
        out = np.zeros((n, len(self.sizes)), np.float32)
        for at in range(0, len(self.values), COLUMNS):
            ours = slice(*np.searchsorted(self.column, (at, at + COLUMNS)))
            theirs = slice(*np.searchsorted(column, (at, at + COLUMNS)))
            if ours.start == ours.stop or theirs.start == theirs.stop:
                continue
            a, b = np.zeros((n, COLUMNS), np.float32), np.zeros((len(self.sizes), COLUMNS), np.float32)
            a[row[theirs], column[theirs] - at] = 1
            b[self.row[ours], self.column[ours] - at] = 1
            out += a @ b.T
        return out

    def links(self, row: np.ndarray, column: np.ndarray, sizes: np.ndarray, num: int, den: int) -> np.ndarray:
        common, good = self.overlaps(row, column, len(sizes)), np.empty((len(sizes), len(self.sizes)), bool)
        for at in range(0, len(sizes), SLICE):  # whole numbers, in slices: a whole tile of them takes four times the counts
            whole = common[at : at + SLICE].astype(np.int64)
            good[at : at + SLICE] = whole * den >= (sizes[at : at + SLICE, None] + self.sizes[None, :] - whole) * num
        return good

    def links_of(self, sets: list[np.ndarray], num: int, den: int) -> np.ndarray:
        """Which of ``sets`` link with which members."""
        sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets)
        column = np.searchsorted(self.values, every)
        known = column < len(self.values)
        known[known] = self.values[column[known]] == every[known]
        row = np.repeat(np.arange(len(sets)), sizes)
        return self.links(*_by_column(row[known], column[known]), sizes, num, den)


def _by_column(row: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(column, kind="stable")
    return row[order], column[order]


def join_members(nodes: list[int], sets: list[np.ndarray], num: int, den: int) -> list[int]:
    """For each member the smallest node of its component inside the group."""
    members = Members(sets, 2)
    label = np.arange(len(nodes))
    for at in range(0, len(nodes), TILE):
        n = min(TILE, len(nodes) - at)
        inside = (members.row >= at) & (members.row < at + n)
        found = members.links(members.row[inside] - at, members.column[inside], members.sizes[at : at + n], num, den)
        for i in range(n):
            linked_labels = np.unique(np.append(label[found[i]], label[at + i]))
            if len(linked_labels) > 1:
                label[np.isin(label, linked_labels)] = linked_labels[0]
    least: dict[int, int] = {}
    for node, k in zip(nodes, label.tolist()):
        least[k] = min(node, least.get(k, node))
    return [least[k] for k in label.tolist()]


def _by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Rows of each group, from batches in which groups are contiguous."""
    held, at = [], None
    for batch in batches:
        columns = [batch.column(k).to_pylist() if k != "shingles" else batch.column(k) for k in batch.schema.names]
        for row in range(batch.num_rows):
            values = {n: c[row] if n != "shingles" else c[row].values.to_numpy() for n, c in zip(batch.schema.names, columns)}
            key = tuple(values[k] for k in keys)
            if key != at and held:
                yield held
                held = []
            at = key
            held.append(values)
    if held:
        yield held


def _contiguous(df: DataFrame, keys: list[str], *then: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *then)


def _local_labels(placed: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``(node, label)`` from joining every group of ``placed(node, token, block, text)`` by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _by_group(shingled(batches, words), ["token", "block"]):
            nodes = [r["node"] for r in group]
            labels = join_members(nodes, [r["shingles"] for r in group], num, den) if len(group) > 1 else nodes
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(labels, pa.int64())], names=["node", "label"])
        release_memory()

    return _contiguous(placed, ["token", "block"], "node").mapInArrow(run, "node long, label long")


def _opened_links(cells: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links ``(a, b)`` of labels, from cells of members and then the texts that opened the group.

    The members of a gathered token (``block`` below zero) are joined with each other too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sets, labels, members, asked = None, [], [], None, []

        def among() -> set:
            if at is None or at[1] >= 0 or len(set(labels)) < 2:
                return set()
            return {(a, b) for a, b in zip(labels, join_members(labels, sets, num, den)) if a != b}

        def answers(ends: bool) -> pa.RecordBatch:
            pairs = among() if ends else set()
            if asked:
                found = members.links_of([s for _, s in asked], num, den)
                for (label, _), hit in zip(asked, found):
                    pairs.update((label, other) for other in np.unique(own[hit]).tolist() if other != label)
                asked.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in shingled(batches, words):
            columns = [batch.column(k).to_pylist() for k in ("token", "block", "query", "label")]
            lists = batch.column("shingles")
            for row, (token, block, query, label) in enumerate(zip(*columns)):
                if (token, block) != at:
                    yield answers(ends=True)
                    at, sets, labels, members = (token, block), [], [], None
                values = lists[row].values.to_numpy()
                if not query:
                    sets.append(values)
                    labels.append(label)
                    continue
                if not sets:  # a block that no text of a gathered token fell into
                    continue
                if members is None:
                    members, own = Members(sets, 1), np.array(labels, np.int64)
                asked.append((label, values))
                if len(asked) == TILE:
                    yield answers(ends=False)
        yield answers(ends=True)
        members, sets = None, []
        release_memory()

    return _contiguous(cells, ["token", "block"], "query").mapInArrow(run, "a long, b long")


def _pair_links(pairs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links ``(a, b)`` of the linked pairs of ``pairs(a, b, text_left, text_right)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in shingled(batches, words):
            left, right = batch.column("shingles_left"), batch.column("shingles_right")
            good = [linked(frozenset(left[i].values.to_pylist()), frozenset(right[i].values.to_pylist()), num, den) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``(node, label)``, the smallest node reachable, for every node of ``links(a, b)``.

    Each round takes the smallest label among neighbours and then the label's own label, so
    chains shrink by more than half.
    """
    edges = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    edges = cut(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = cut(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while not labels.isEmpty():
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        step = labels.join(near, labels.node == near.a).select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = step.select(F.col("node").alias("j"), F.col("label").alias("jump"))
        step = cut(step.join(jump, step.label == jump.j, "left").select("node", "was", F.least("label", F.coalesce("jump", "label")).alias("label")))
        done = step.filter("label <> was").isEmpty()
        labels = step.select("node", "label")
        if done:
            break
    return labels


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    links = cut(links.distinct())
    if links.isEmpty():
        return labels
    merged = components(links).select(F.col("node").alias("m_node"), F.col("label").alias("m_label"))
    joined = labels.join(merged, labels.label == merged.m_node, "left")
    return cut(joined.select("node", F.coalesce("m_label", "label").alias("label")))


def _enough(live: DataFrame, nodes: DataFrame) -> DataFrame:
    """``live(node, tokens)`` with ``least`` and the tokens of either parity in order, ``t0`` and ``t1``: none if fewer than any linked text shares."""
    out = live.join(nodes.select("node", "least"), "node")
    for parity in (0, 1):
        own = F.filter("tokens", lambda t: F.pmod(t, F.lit(2)) == parity)  # noqa: B023
        out = out.withColumn(f"t{parity}", F.when(F.size(own) >= F.col("least")[parity], own).otherwise(F.array().cast("array<long>")))
    return out


def row_labels(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100, group_shingles: int = GROUP_SHINGLES, group_members: int = GROUP_MEMBERS) -> DataFrame:
    """``(doc_id, row_key, n_shingles, label)`` for every row of ``docs``: one label a component, null without shingles."""
    with Scratch(docs.sparkSession) as scratch, small_batches(docs.sparkSession):
        return _row_labels(scratch, docs, words, num, den, group_shingles, group_members)


def _row_labels(scratch: Scratch, docs: DataFrame, words: int, num: int, den: int, group_shingles: int, group_members: int) -> DataFrame:
    rows = scratch.table("rows", features(docs, words, num, den))
    ids = cut(rows.select("doc_id", "row_key", "n_shingles", "node", "least"))
    nodes = ids.filter("node IS NOT NULL").groupBy("node").agg(
        F.max("n_shingles").alias("n"), F.min(F.struct("doc_id", "row_key")).alias("row"), F.max("least").alias("least")
    )
    tokens = rows.filter("n_shingles > 0").select("node", F.explode("tokens").alias("token"))
    parts = []
    for k in range(TOKEN_PASSES):  # a share of the tokens at a time is shuffled, which bounds the disk it takes
        # One sort finds the tokens of several texts; nearly all others go before the next shuffle.
        of_token = Window.partitionBy("token")
        own = tokens.filter(F.pmod(F.shiftright("token", 1), F.lit(TOKEN_PASSES)) == k)
        shared = own.withColumns({"lo": F.min("node").over(of_token), "hi": F.max("node").over(of_token)}).filter("lo < hi")
        parts.append(cut(shared.groupBy("node").agg(F.collect_set("token").alias("tokens"))))
        del own, shared
        release_shuffles(docs.sparkSession)
    live = functools.reduce(DataFrame.unionByName, parts).groupBy("node").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    scratch.drop("rows")
    del rows, tokens
    # A text with fewer live tokens than any linked text would share has no link.
    live = cut(_enough(live, nodes).select("node", F.explode(F.concat("t0", "t1")).alias("token")))
    again = live.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("texts")).filter("lo < hi")
    live = cut(live.join(again, "token").select("token", "node", "texts"))
    rarest = live.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("texts", "token"))).alias("rare"))
    rarest = _enough(rarest.select("node", F.col("rare.token").alias("tokens")), nodes)
    first = [F.slice(F.col(f"t{p}"), F.lit(1), F.greatest(F.size(f"t{p}") - F.col("least")[p] + 1, F.lit(0)).cast("int")) for p in (0, 1)]
    sought = cut(rarest.select("node", F.explode(F.concat(*first)).alias("token")))

    smallest = live.groupBy("node").agg(F.min("token").alias("home"))
    shared = live.join(smallest, "node").groupBy("token").agg(F.min("home").alias("home"))
    home = live.join(shared, "token").groupBy("node").agg(F.min("home").alias("token"))
    home = cut(home.join(nodes, "node"))
    sizes = home.groupBy("token").agg(F.ceil(F.greatest(F.sum("n") / F.lit(group_shingles), F.count("*") / F.lit(group_members))).alias("blocks"))
    chosen = cut(
        home.join(sizes, "token").select("node", "token", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long").alias("block"), F.col("row.row_key").alias("row_key"), "n")
    )
    homes = chosen.select("node", "token", "block", "n")
    # De-duplication and join share one shuffle of the texts.
    texts = docs.select(F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row_key"), "text").dropDuplicates(["row_key"])
    texts = texts.join(chosen, "row_key").select("node", "token", "block", "text")
    placed = scratch.table("placed", texts)
    sets = placed.select("node", "text")
    del texts
    release_shuffles(docs.sparkSession)

    labels = cut(_local_labels(placed, words, num, den))
    release_shuffles(docs.sparkSession)

    where = homes.withColumnsRenamed({"token": "g_token", "block": "g_block"})
    marked = cut(sought.join(where, "node").join(labels, "node"))
    matrix = marked.groupBy("token", "g_token", "g_block").agg(
        F.min("node").alias("rep"), F.min("label").alias("lo"), F.max("label").alias("hi")
    )
    first = matrix.groupBy("token").agg(F.min("rep").alias("first"))
    reps = matrix.join(first, "token").filter("rep <> first").select("rep", "first").distinct()
    one, two = (
        sets.join(labels, "node").select(F.col("node").alias(n), F.col("label").alias(label), F.col("text").alias(side))
        for n, label, side in (("rep", "a", "text_left"), ("first", "b", "text_right"))
    )
    pairs = reps.join(one, "rep").join(two, "first").filter("a <> b").select("a", "b", "text_left", "text_right")
    labels = _relabel(labels, _pair_links(pairs, words, num, den))

    marked = cut(marked.drop("label").join(labels, "node"))
    matrix = cut(
        marked.groupBy("token", "g_token", "g_block").agg(
            F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("texts"), F.sum("n").alias("n")
        )
    )
    # Tokens whose texts are not known to be of one component.
    open_tokens = matrix.groupBy("token").agg(
        F.count("*").alias("groups"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("texts").alias("texts"), F.sum("n").alias("n")
    ).filter("lo < hi AND groups > 1")
    blocks = F.ceil(F.greatest(F.col("n") / F.lit(group_shingles), F.col("texts") / F.lit(group_members))).alias("blocks")
    open_tokens = cut(open_tokens.select("token", "groups", blocks))
    few = open_tokens.filter(F.col("groups") <= OPEN_GROUPS).select("token")
    asked = marked.join(few, "token").select("token", "node", "label", F.col("g_token").alias("own_token"), F.col("g_block").alias("own_block"))
    elsewhere = ~((F.col("g_token") == F.col("own_token")) & (F.col("g_block") == F.col("own_block")))
    unknown = (F.col("lo") != F.col("label")) | (F.col("hi") != F.col("label"))
    opened = asked.join(matrix.join(few, "token"), "token").filter(elsewhere & unknown).select("node", "g_token", "g_block").distinct()
    opened = cut(opened.withColumnsRenamed({"g_token": "token", "g_block": "block"}))
    gathered = marked.join(open_tokens.filter(F.col("groups") > OPEN_GROUPS), "token")
    gathered = gathered.select("token", "node", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("long").alias("own"))
    # In its own block a text is a member, in the blocks before it a query.
    gathered = gathered.select("token", "node", "own", F.explode(F.sequence(F.lit(0).cast("long"), "own")).alias("k"))
    gathered = cut(gathered.select("token", (-1 - F.col("k")).alias("block"), "node", (F.col("k") < F.col("own")).alias("query")))
    if not opened.isEmpty() or not gathered.isEmpty():
        members = placed.join(opened.select("token", "block").distinct(), ["token", "block"]).select("token", "block", "node", "text", F.lit(False).alias("query"))
        queries = opened.withColumn("query", F.lit(True)).union(gathered.select("node", "token", "block", "query"))
        queries = queries.join(sets, "node").select("token", "block", "node", "text", "query")
        cells = members.union(queries).join(labels, "node")
        labels = _relabel(labels, _opened_links(cells.select("token", "block", "query", "label", "text"), words, num, den))

    known = labels.select(F.col("node").alias("l_node"), "label")
    return cut(ids.join(known, ids.node == known.l_node, "left").select("doc_id", "row_key", "n_shingles", F.coalesce("label", "node").alias("label")))


def link_components(docs: DataFrame, words: int = 3, num: int = 90, den: int = 100, group_shingles: int = GROUP_SHINGLES, group_members: int = GROUP_MEMBERS) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs``."""
    named = row_labels(docs, words, num, den, group_shingles, group_members)
    least = named.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("least")).withColumnRenamed("label", "k")
    out = named.join(least, named.label == least.k, "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of ``docs`` of each component, the one with the smallest id (null last), then row
    key; texts without shingles stay. Rows equal in id and text stay or go together."""
    found = row_labels(docs, words, num, den).filter("label IS NOT NULL").select("label", F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key").alias("row"))
    first = found.groupBy("label").agg(F.min("row").alias("first"))
    gone = found.join(first, "label").filter(~same(F.col("row.row_key"), F.col("first.row_key"))).select(F.col("row.row_key").alias("__gone")).distinct()
    return docs.join(gone, F.xxhash64(F.col("doc_id").cast("long"), "text") == F.col("__gone"), "left_anti")
