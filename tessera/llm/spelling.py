"""Grouping of spelling variants with PartEnum signatures.

Words are runs of Latin letters, counted over whole texts. Two words are near if they differ by exactly
one inserted, deleted or replaced code point; a word's form is a much more frequent near word,
and its root the end of the chain of forms.

Near words are found by their letters. A word's letter multiset is a binary vector over
(letter, how often so far); a replacement changes it in two places at most, an insertion or
deletion in one. Partition and enumerate: the dimensions are dealt into ``n`` parts by a
hash, and vectors within Hamming distance ``k`` agree on some ``n - k`` of them, so every choice
of ``n - k`` parts gives a signature: ``EQUAL_PARTS`` parts for pairs of equal length
(``k = 2``), ``APART_PARTS`` for lengths that differ by one (``k = 1``). One edit also leaves
either the first or the last half of a word as it was, so a signature holds the lengths and one
of the halves too, which makes it selective.

Words are joined on equal signatures and every pair is verified by its edit distance. A
signature of more than ``GROUP`` words is not joined as it is: its words go on to signatures with one letter
left out, where all that meet are near, so no group yields pairs by its square. All of it
is exact; signatures are 64-bit hashes, and a collision costs a verification.

Scale: words of a task are counted before the shuffle; later steps move distinct words that occur ``LEAST``
times, a few dozen rows of about thirty bytes each. Chains of forms shorten by half a round.

Results for special rows: null and empty texts have no words; a null document id counts as an
empty one in the hash that deletes a letter; repeated rows count each time; an empty
table, or one without frequent words, gives no rows; words of any length are taken whole; of near words
equally frequent the first in code-point order is the form; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, release_memory

LETTERS = 6
LEAST = 5
#: A form is at least so many times as frequent as the word.
RATIO = 5
EQUAL_PARTS = 5
APART_PARTS = 3
GROUP = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SIGNATURE = "key long, shorter boolean, word string, n long"
REFINED = "key long, shorter boolean, both boolean, word string, n long"


def runs(docs: DataFrame, letters: int = LETTERS) -> DataFrame:
    """``(id, run)``: every lowered run of at least ``letters`` Latin letters."""
    pattern = F.lit(r"[a-zÀ-ÿ]{%d,}" % letters)
    found = F.regexp_extract_all(F.translate("text", UPPER, LOWER), pattern, 0)
    return docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))


def misspelt(doc_id: Column, run: Column, modulus: int) -> Column:
    """The run without one letter where ``modulus`` divides the hash of id and run."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % modulus == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def word_counts(docs: DataFrame, modulus: int | None = None, letters: int = LETTERS, least: int = LEAST) -> DataFrame:
    """``(word, n)`` of the words of at least ``letters`` letters that occur ``least`` times."""
    found = runs(docs, letters)
    word = F.col("run") if modulus is None else misspelt(F.col("id"), F.col("run"), modulus)
    counts = found.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter((F.length("word") >= letters) & (F.col("n") >= least))


def letter_parts(word: str, parts: int, place) -> list[str]:
    """The word's (letter, how often so far) pairs, dealt into parts, each in sorted order."""
    out: list[list[str]] = [[] for _ in range(parts)]
    before, times = "", 0
    for letter in sorted(word):
        times = times + 1 if letter == before else 0
        before = letter
        out[place(letter, times) % parts].append(f"{letter}{times}")
    return [" ".join(x) for x in out]


def signatures(word: str, equal_parts: int = EQUAL_PARTS, apart_parts: int = APART_PARTS) -> Iterator[tuple[int, bool]]:
    """Signed 64-bit keys of a word, and whether it stands as the shorter of a pair.

    Pairs of equal length have the flag set on both sides.
    """
    import xxhash

    known: dict[tuple[str, int], int] = {}

    def place(letter: str, times: int) -> int:
        if (letter, times) not in known:
            known[letter, times] = xxhash.xxh32_intdigest(f"{letter}{times}")
        return known[letter, times]

    size = len(word)
    for parts, apart, tags in ((equal_parts, 2, [(size, True)]), (apart_parts, 1, [(size, True), (size - 1, False)])):
        dealt = letter_parts(word, parts, place)
        # A pair of lengths (s, s), or (s, s + 1), shares a first or a last half of these sizes.
        halves = [(s, s // 2, (s + 1) // 2, flag) if apart == 2 else (s, (s + 1) // 2, s // 2 + 1, flag) for s, flag in tags]
        for chosen in combinations(range(parts), parts - apart):
            same = f"{apart} {chosen} " + "|".join(dealt[i] for i in chosen)
            for shorter, first, last, flag in halves:
                for half in (f"<{word[:first]}", f">{word[size - last :]}"):
                    yield xxhash.xxh64_intdigest(f"{same} {shorter}{half}") - (1 << 63), flag


def left_out(word: str) -> list[int]:
    """A hash of the word without its letter i, for every i; linear in its length."""
    base, prime = 1_000_003, (1 << 61) - 1
    before, power = [0], [1]
    for c in word:
        before.append((before[-1] * base + ord(c)) % prime)
        power.append(power[-1] * base % prime)
    n = len(word)
    return [(before[i] * power[n - 1 - i] + before[n] - before[i + 1] * power[n - 1 - i]) % prime for i in range(n)]


def whole_hash(word: str) -> int:
    base, prime, h = 1_000_003, (1 << 61) - 1, 0
    for c in word:
        h = (h * base + ord(c)) % prime
    return h


def _signed(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, flags, at = [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                for key, flag in signatures(word):
                    keys.append(key)
                    flags.append(flag)
                    at.append(i)
            taken = batch.select(["word", "n"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(flags, pa.bool_()), *taken.columns], names=["key", "shorter", "word", "n"])
        release_memory()

    return words.mapInArrow(run, SIGNATURE)


def _refined(rows: DataFrame) -> DataFrame:
    """Signatures of large groups, with one letter left out: those that meet are near.

    Words of equal length meet where they agree but for the letter at one place, words of
    lengths that differ by one where the longer without a letter is the shorter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            keys, flags, at = [], [], []
            for i, (key, shorter, both, word) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("key", "shorter", "both", "word")])):
                if not both:  # only one length: a replacement
                    own = {f"{key} {place} {h}" for place, h in enumerate(left_out(word))}
                else:
                    own = {f"{key} {whole_hash(word)}"} if shorter else {f"{key} {h}" for h in left_out(word)}
                keys += [xxhash.xxh64_intdigest(x) - (1 << 63) for x in own]
                flags += [shorter] * len(own)
                at += [i] * len(own)
            taken = batch.select(["both", "word", "n"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(flags, pa.bool_()), *taken.columns], names=["key", "shorter", "both", "word", "n"])
        release_memory()

    return rows.mapInArrow(run, REFINED)


def _joined(rows: DataFrame) -> DataFrame:
    """Verified pairs ``(a, a_n, b, b_n)`` of words that share a key."""
    left = rows.select("key", "both", F.col("shorter").alias("a_short"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = rows.select("key", F.col("shorter").alias("b_short"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    # Each pair once: the shorter word, or the first of two of equal length, on the left.
    once = F.col("a_short") & F.when(F.col("both"), ~F.col("b_short")).otherwise(F.col("a") < F.col("b"))
    pairs = left.join(right, "key").filter(once)
    return pairs.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """``(a, a_n, b, b_n)``: every pair of near words of ``words(word, n)`` once."""
    signed = cut(_signed(words))
    # A key stands for one kind of pair; it is worth joining if both sides have a word.
    sizes = signed.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.count_if("shorter").alias("short"), F.max(~F.col("shorter")).alias("long")
    )
    sizes = sizes.filter("size > 1 AND short > 0")
    live = cut(signed.join(sizes.select("key", (F.col("size") > group).alias("large"), F.col("long").alias("both")), "key"))
    few = _joined(live.filter("NOT large").drop("large"))
    many = _joined(_refined(live.filter("large").drop("large")))
    return few.unionByName(many).distinct()


def forms(words: DataFrame, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """``(word, n, n_near, form, form_n)`` for every row of ``words(word, n)``."""
    pairs = cut(near_pairs(words, group))
    both = pairs.select(F.col("a").alias("w"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionByName(
        pairs.select(F.col("b").alias("w"), F.col("a").alias("other"), F.col("a_n").alias("other_n"))
    )
    best = both.groupBy("w").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    out = words.join(best, words.word == best.w, "left")
    good = -F.col("best.less") >= ratio * F.col("n")
    return out.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best.other")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n"),
    )


def roots(named: DataFrame) -> DataFrame:
    """``(word, root)`` of the words that have a form: the end of their chain of forms.

    A form is more frequent than its word, so chains end; each round joins a chain with itself.
    """
    chain = cut(named.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = chain.select(F.col("word").alias("w"), F.col("root").alias("further"))
        step = cut(chain.join(on, chain.root == on.w, "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        chain = step.drop("moved")
        if step.filter("moved").isEmpty():
            return chain


def spelling_variants(docs: DataFrame, modulus: int | None = None, letters: int = LETTERS, least: int = LEAST, ratio: int = RATIO, group: int = GROUP) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of the frequent words of ``docs``.

    With ``modulus``, occurrences chosen by a hash of id and word lose a letter first.
    """
    words = cut(word_counts(docs, modulus, letters, least))
    named = cut(forms(words, ratio, group))
    ends = roots(named).withColumnRenamed("word", "w")
    out = named.join(ends, named.word == ends.w, "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
