"""Language identification with string kernels.

Kernel: a text is the set of character n-grams (1 to ``MAX_N``, the blended spectrum) that
occur in it, counted as present or absent after lower-casing and turning every run of
non-letters into a space. ``k(x, y) = |x & y| / sqrt(|x| |y|)`` over the n-grams that occur
in at least two landmarks.

Model: Nystroem landmarks and one-versus-rest kernel ridge regression,
``beta = (C'C + r n W)^-1 C'Y`` with ``C = k(rows, landmarks)``, ``W = k(landmarks, landmarks)``
and ``Y`` of +1 and -1. It is fitted on the driver from a bounded sample: at most
``ROWS_PER_LANGUAGE`` labelled rows a language, chosen by a hash of id and text. Of a text
longer than ``ROW_CHARS`` characters the sample holds as many from a place chosen by that hash.

Scoring runs over whole texts of any length, in batches: the n-grams of a batch become a
0/1 matrix, its product with the landmark matrix gives the kernel block and a second
product the scores. Memory is bounded by the batch, not by the text, because long texts
are read in segments that set ones in the same matrix row.

Results for special rows: a null text, or one without a letter, is ``und`` with score 0;
a text with letters but no n-gram of any landmark gets the first language with an even score;
rows with a null language are not used for fitting but are scored; if nothing can be
fitted all rows are ``und`` with score 0; a null id is scored like any other; repeated rows get equal
results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
LETTER = r"\p{L}"
MAX_N = 3
ROWS_PER_LANGUAGE = 400
ROW_CHARS = 6000
LANDMARKS_PER_LANGUAGE = 32
RIDGE = 1e-3
SHARPNESS = 4.0
BATCH = 64
SEGMENT = 1 << 20
HASH_BITS = 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def letter_table() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def code_points(text: str, letters: np.ndarray) -> np.ndarray:
    """Lower-cased code points, non-letters as spaces, runs of spaces as one."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    a = np.where(letters[a], a, 32).astype(np.uint64)
    if len(a) > 1:
        a = a[np.concatenate(([True], (a[1:] != 32) | (a[:-1] != 32)))]
    return a


def ngram_codes(a: np.ndarray, n: int) -> np.ndarray:
    """An exact 64-bit code for every n-gram of ``a`` (21 bits a character; n is at most 3)."""
    m = len(a) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    code = a[:m].copy()
    for k in range(1, n):
        code = (code << np.uint64(21)) | a[k : k + m]
    return code


class Model:
    """Landmark matrix, regression weights and the n-gram table; bounded by the landmarks' number and length."""

    def __init__(self, languages: list[str], codes: np.ndarray, landmarks: np.ndarray, beta: np.ndarray, max_n: int):
        self.languages, self.codes, self.landmarks, self.beta, self.max_n = languages, codes, landmarks, beta, max_n
        self.table = None

    def state(self) -> dict:
        """What a model is made from again: lists and arrays, which need no class to unpickle."""
        return {"languages": self.languages, "codes": self.codes, "landmarks": self.landmarks, "beta": self.beta, "max_n": self.max_n}

    def prepare(self) -> "Model":
        if self.table is None:
            self.letters = letter_table()
            self.table = np.full(1 << HASH_BITS, -1, np.int32)
            self.table[slot(self.codes)] = np.arange(len(self.codes), dtype=np.int32)
            # Codes that share a slot with a later one are looked up in order.
            lost = np.flatnonzero(self.table[slot(self.codes)] != np.arange(len(self.codes)))
            self.rest = lost[np.argsort(self.codes[lost])]
            self.crowded = np.zeros(1 << HASH_BITS, bool)
            self.crowded[slot(self.codes[lost])] = True
        return self

    def features(self, codes: np.ndarray) -> np.ndarray:
        """Columns of the codes that are features."""
        at = slot(codes)
        found = self.table[at]
        same = (found >= 0) & (self.codes[found] == codes)
        missed = codes[~same & self.crowded[at]]
        if not len(missed):
            return found[same]
        place = np.minimum(np.searchsorted(self.codes[self.rest], missed), len(self.rest) - 1)
        more = self.rest[place][self.codes[self.rest[place]] == missed]
        return np.concatenate((found[same], more))

    def presence(self, texts: list[str]) -> np.ndarray:
        """The 0/1 matrix of texts by features."""
        width = len(self.codes)
        out = np.zeros((len(texts), width), np.float32)
        flat = out.reshape(-1)
        for row, text in enumerate(texts):
            for at in range(0, max(len(text), 1), SEGMENT):
                # Segments overlap by more than the longest n-gram.
                a = code_points(text[at : at + SEGMENT + 8], self.letters)
                for n in range(1, self.max_n + 1):
                    flat[row * width + self.features(ngram_codes(a, n))] = 1
        return out

    def kernel(self, texts: list[str]) -> np.ndarray:
        p = self.presence(texts)
        norm = np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))
        return (p @ self.landmarks) / norm

    def scores(self, texts: list[str]) -> np.ndarray:
        """Per text and language: softmax of the regression values."""
        f = (self.kernel(texts).astype(np.float64) @ self.beta) * SHARPNESS
        e = np.exp(f - f.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)


def slot(codes: np.ndarray) -> np.ndarray:
    return ((codes * MULTIPLIER) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def fit(texts: list[str], langs: list[str], max_n: int = MAX_N, landmarks: int = LANDMARKS_PER_LANGUAGE) -> Model | None:
    """Fit on labelled texts; None if there are none with letters."""
    letters = letter_table()
    kept = [(t, y) for t, y in zip(texts, langs) if letters[np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)].any()]
    if not kept:
        return None
    texts, langs = [t for t, _ in kept], [y for _, y in kept]
    languages = sorted(set(langs))
    marks = [i for y in languages for i in [j for j, z in enumerate(langs) if z == y][:landmarks]]
    seen: dict[int, int] = {}
    for i in marks:
        a = code_points(texts[i], letters)
        for code in {int(c) for n in range(1, max_n + 1) for c in ngram_codes(a, n)}:
            seen[code] = seen.get(code, 0) + 1
    least = 2 if len(marks) > 1 else 1
    ranked = sorted((c for c, k in seen.items() if k >= least), key=lambda c: (-seen[c], c)) or sorted(seen)
    model = Model(languages, np.array(ranked, np.uint64), None, None, max_n).prepare()
    p = model.presence([texts[i] for i in marks])
    model.landmarks = (p / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))).T.copy()
    c = np.vstack([model.kernel(texts[i : i + BATCH]) for i in range(0, len(texts), BATCH)]).astype(np.float64)
    w = (model.landmarks.T @ model.landmarks).astype(np.float64)
    y = np.array([[1.0 if z == lang else -1.0 for lang in languages] for z in langs])
    counts = np.array([langs.count(z) for z in langs], float)
    weight = (len(langs) / (len(languages) * counts))[:, None]  # every language counts the same
    left = c.T @ (c * weight) + RIDGE * len(langs) * w + 1e-8 * np.eye(len(marks))
    model.beta = np.linalg.solve(left, c.T @ (y * weight))
    return model


def training_rows(docs: DataFrame, usable: Column, per_language: int = ROWS_PER_LANGUAGE, chars: int = ROW_CHARS) -> DataFrame:
    """The bounded sample: ``text, lang`` of at most ``per_language`` rows with a letter a language,
    of a longer text a segment of ``chars`` characters."""
    key = F.xxhash64("doc_id", "text")
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").rlike(LETTER)).select("text", "lang", key.alias("key"))
    # Cut before the shuffle, so that it holds the sampled segment only.
    at = F.pmod(F.xxhash64("key"), F.greatest(F.length("text") - chars + 1, F.lit(1))).cast("int")
    part = F.substr("text", at + 1, F.lit(chars))
    # A stretch without letters moves to the text's first letter.
    lettered = F.regexp_replace("text", r"^\P{L}+", "")
    rows = rows.select(F.when(part.rlike(LETTER), part).otherwise(F.left(lettered, F.lit(chars))).alias("text"), "lang", "key")
    first = Window.partitionBy("lang").orderBy("key", "text")
    return rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= per_language).select("text", "lang", "key")


def fit_on(docs: DataFrame, usable: Column) -> Model | None:
    rows = sorted(training_rows(docs, usable).collect(), key=lambda r: (r["lang"], r["key"], r["text"]))
    return fit([r["text"] for r in rows], [r["lang"] for r in rows])


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to every row of ``docs`` (the text column must be ``text``)."""
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    # The state, not the model: a broadcast names the class of an instance, and executors need no copy of this package.
    shared = docs.sparkSession.sparkContext.broadcast({"state": model.state()})
    schema = docs.limit(0).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value  # kept by a worker from one task to the next
        model = held.get("model") or held.setdefault("model", Model(**held["state"]).prepare())
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, values = [UNKNOWN] * len(texts), [0.0] * len(texts)
            known = [i for i, t in enumerate(texts) if t and model.letters[np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)].any()]
            for at in range(0, len(known), BATCH):
                part = known[at : at + BATCH]
                s = model.scores([texts[i] for i in part])
                for i, best, value in zip(part, s.argmax(axis=1), s.max(axis=1)):
                    names[i], values[i] = model.languages[best], float(value)
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(score, schema)
