"""Toxicity by nearest labelled examples.

Examples are a bounded sample of labelled rows that have a text: at most ``EXAMPLES`` rows, chosen
by a hash; of a text longer than ``EXAMPLE_CHARS`` characters, as many from a place chosen by a
hash. Of several texts of one id the one with the smallest hash counts. Terms are words of letters; those whose
presence goes with the label (a standard score of at least ``LEAST_Z`` over at least
``LEAST_TEXTS`` examples) make the vocabulary. Texts are TF-IDF vectors over it, of length 1.

The index is inverted: for each term, the blocks of examples that hold it with the largest
weight in each block. A search adds those maxima to get a bound for every block, opens
blocks from the highest bound down, and stops when no bound reaches the k-th best cosine, so
the k nearest are exact. They vote with the square of their cosine, against a prior of one
vote at the overall rate. Votes of the examples themselves, each searched without itself,
give a rising step function (pool adjacent violators) that turns votes into rates of label
1: the score. The neighbours are returned as evidence.

Results for special rows: null and empty texts, and texts without a term of the vocabulary,
have no neighbours and get the rate of such examples; null labels are not used, and of
several labels of one id the larger counts; with no usable label every score is 0; repeated
rows get equal results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXAMPLES = 6000
EXAMPLE_CHARS = 20_000
LEAST_Z = 6.0
LEAST_TEXTS = 5
MAX_TERMS = 1024
BLOCK = 64
NEIGHBOURS = 15
SEGMENT = 1 << 20

_TERM = re.compile(r"[^\W\d_]+")


def terms(text: str | None) -> list[str]:
    return _TERM.findall((text or "").lower())


class Index:
    """Block-max inverted index over example vectors."""

    def __init__(self, rows: list[dict[int, float]], width: int, block: int = BLOCK):
        # Examples with the same heaviest term stand together, which lowers the other blocks' bounds.
        self.order = sorted((i for i, r in enumerate(rows) if r), key=lambda i: (max((w, -t) for t, w in rows[i].items())[::-1], i))
        self.block, self.blocks = block, -(-len(self.order) // block)
        self.largest = np.zeros((width, max(1, self.blocks)))
        self.lists: dict[tuple[int, int], list] = {}
        for place, i in enumerate(self.order):
            b = place // block
            for t, w in rows[i].items():
                self.lists.setdefault((t, b), []).append((place % block, w))
                self.largest[t, b] = max(self.largest[t, b], w)
        self.lists = {k: (np.array([p for p, _ in v]), np.array([w for _, w in v])) for k, v in self.lists.items()}

    def search(self, query: dict[int, float], k: int, without: int = -1) -> list[tuple[float, int]]:
        """The k examples of largest cosine above 0, as (cosine, example), ties to the smaller example."""
        if not query or not self.blocks:
            return []
        ts = sorted(query)
        bounds = np.array([query[t] for t in ts]) @ self.largest[ts]
        best: list[tuple[float, int]] = []
        for b in np.argsort(-bounds, kind="stable").tolist():
            if bounds[b] <= 0 or len(best) == k and bounds[b] < -best[-1][0] - 1e-9:
                break
            sums = np.zeros(self.block)
            for t in ts:
                if (found := self.lists.get((t, b))) is not None:
                    sums[found[0]] += query[t] * found[1]
            new = [(-s, self.order[b * self.block + p]) for p, s in enumerate(sums.tolist()) if s > 0]
            best = sorted([*best, *[x for x in new if x[1] != without]])[:k]
        return [(-s, i) for s, i in best]


class Model:
    """Vocabulary, index and calibration; bounded by the parameters."""

    def __init__(self, texts: list[str], labels: list[int], ids: list[int], k: int = NEIGHBOURS):
        self.k, self.labels, self.ids = k, labels, ids
        self.rate = sum(labels) / len(labels) if labels else 0.0
        counts = [Counter(terms(t)) for t in texts]
        every, toxic = Counter(), Counter()
        for c, y in zip(counts, labels):
            every.update(c.keys())
            if y:
                toxic.update(c.keys())
        p = self.rate
        z = {t: (toxic[t] - n * p) / math.sqrt(n * p * (1 - p)) for t, n in every.items() if n >= LEAST_TEXTS} if 0 < p < 1 else {}
        chosen = sorted((t for t in z if z[t] >= LEAST_Z), key=lambda t: (-z[t], t))[:MAX_TERMS]
        self.vocabulary = {t: i for i, t in enumerate(chosen)}
        self.idf = [math.log((1 + len(texts)) / (1 + every[t])) + 1 for t in chosen]
        vectors = [self.vector(c) for c in counts]
        self.index = Index(vectors, len(chosen))
        votes = [self.vote(self.index.search(v, k, i)) for i, v in enumerate(vectors)]
        self.steps, self.rates = rising(votes, labels)

    def vector(self, counts: dict[str, int]) -> dict[int, float]:
        v = {self.vocabulary[t]: (1 + math.log(n)) * self.idf[self.vocabulary[t]] for t, n in sorted(counts.items()) if t in self.vocabulary}
        length = math.sqrt(sum(w * w for w in v.values()))
        return {t: w / length for t, w in v.items()}

    def vote(self, found: list[tuple[float, int]]) -> float:
        weight = sum(c * c for c, _ in found)
        return (sum(c * c * self.labels[i] for c, i in found) + self.rate) / (weight + 1)

    def calibrated(self, vote: float) -> float:
        return float(np.interp(vote, self.steps, self.rates)) if self.steps else 0.0

    def score(self, text: str | None) -> tuple[float, list[tuple[float, int]]]:
        counts: Counter = Counter()
        text = text or ""
        for part in segments(text):
            counts.update(filter(self.vocabulary.__contains__, terms(part)))
        found = self.index.search(self.vector(counts), self.k)
        return self.calibrated(self.vote(found)), found


    def state(self) -> dict:
        """What a model is made from again: plain values, which need no class to unpickle."""
        return self.__dict__ | {"index": self.index.__dict__}

    @classmethod
    def of(cls, state: dict) -> Model:
        model, index = cls.__new__(cls), Index.__new__(Index)
        index.__dict__.update(state["index"])
        model.__dict__.update(state | {"index": index})
        return model


def segments(text: str) -> Iterator[str]:
    """The whole text in parts of about ``SEGMENT`` characters that end at white space, if there is any."""
    at = 0
    while at < len(text):
        end = at + SEGMENT
        while end < len(text) and not text[end].isspace():
            end += 1
        yield text[at:end]
        at = end


def rising(votes: list[float], labels: list[int]) -> tuple[list[float], list[float]]:
    """Least-squares rising steps of label rate over votes: pool adjacent violators."""
    pools: list[list[float]] = []  # sum of labels, count, sum of votes
    by_vote: dict[float, list[float]] = {}
    for v, y in zip(votes, labels):
        one = by_vote.setdefault(round(v, 9), [0.0, 0.0])
        one[0] += y
        one[1] += 1
    for v in sorted(by_vote):
        y, n = by_vote[v]
        pools.append([y, n, v * n])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return [p[2] / p[1] for p in pools], [p[0] / p[1] for p in pools]


def fit(docs: DataFrame, labels: DataFrame, usable: Column, examples: int = EXAMPLES, chars: int = EXAMPLE_CHARS) -> Model | None:
    """Fit on labelled rows for which ``usable`` (over ``doc_id``) holds; None if there are none."""
    known = labels.filter(usable & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.filter(F.length("text") > 0).select("doc_id", F.xxhash64("text").alias("key"), "text")
    chosen = texts.select("doc_id", "key").join(known, "doc_id").groupBy("doc_id").agg(F.min("key").alias("key"), F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(examples)
    # At most ``examples`` rows of three integers.
    rows = texts.join(F.broadcast(chosen), ["doc_id", "key"])
    at = F.pmod(F.xxhash64("key"), F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int")
    rows = rows.select("doc_id", F.substr("text", at + 1, F.lit(chars)).alias("text"), "toxic").dropDuplicates(["doc_id"]).collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"], r["text"]))
    if not rows:
        return None
    return Model([r["text"] for r in rows], [int(r["toxic"] != 0) for r in rows], [int(r["doc_id"]) for r in rows])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add ``score``, ``predicted`` and ``evidence`` (id, label and cosine of the neighbours); drops ``text``."""
    evidence = "array<struct<doc_id:bigint,label:int,cosine:double>>"
    if model is None:
        return docs.drop("text").withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "evidence": F.array().cast(evidence)})
    # The state, not the model: a broadcast names the class of an instance, and executors need no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast({"state": model.state()})
    schema = docs.drop("text").limit(0).withColumns({"score": F.lit(0.0), "predicted": F.lit(0), "evidence": F.array().cast(evidence)}).schema
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value  # kept by a worker from one task to the next
        model = held.get("model") or held.setdefault("model", Model.of(held["state"]))
        for batch in batches:
            found = [model.score(t) for t in batch.column("text").to_pylist()]
            rows = [[{"doc_id": model.ids[i], "label": model.labels[i], "cosine": c} for c, i in near] for _, near in found]
            keep = [n for n in batch.schema.names if n != "text"]
            columns = [*[batch.column(n) for n in keep], pa.array([s for s, _ in found], pa.float64()), pa.array([int(s >= 0.5) for s, _ in found], pa.int32()), pa.array(rows, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", "predicted", "evidence"])

    return docs.mapInArrow(run, schema)
