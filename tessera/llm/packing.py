"""Packing documents into fixed windows by minimum bin slack.

A document is its token ids followed by the end id. Documents longer than a window are cut
into full windows and a remainder; remainders stay whole. Each window starts with the
longest piece left, and a subset-sum over the multiset of lengths left (a Python integer
as bitset, counts split into powers of two) finds the filling closest to the capacity; walking
back through the stored bitsets gives how many pieces of each length to take.

Scale: token ids never leave the task that made them; pieces are rows of a few integers.
They are dealt into shards of about ``SHARD_PIECES`` pieces by a hash (of their place too, so that
repeated rows part), and each shard packs by itself, so only the last window of a shard has slack worth naming.

Results for special rows: a null text is empty and yields the end id alone; a null id is
carried through; repeated rows are separate documents; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release_memory, small_batches

CAPACITY = 2048
END_ID = 1
SHARD_PIECES = 8192
#: Words, and cuts of words, whose ids a worker keeps; about 100 bytes each.
CACHE_WORDS = 500_000
CHUNK_BYTES = 4 << 20


def _take(capacity: int, counts: dict[int, int]) -> list[int]:
    """Lengths, from ``counts``, whose sum is the largest not above ``capacity``."""
    mask, reach, steps = (1 << (capacity + 1)) - 1, 1, []
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        steps.append((length, reach))
        left, part = min(counts[length], capacity // length), 1
        while left:
            part = min(part, left)
            reach |= (reach << (length * part)) & mask
            left -= part
            part *= 2
        if reach >> capacity & 1:
            break
    total, out = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        while not before >> total & 1:
            out.append(length)
            total -= length
    return out


def minimum_bin_slack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Partition the positions of ``lengths`` (each at most ``capacity``) into windows."""
    at: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        at.setdefault(lengths[i], []).append(i)
    counts = {x: len(v) for x, v in at.items()}

    def pull(length: int) -> int:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
        return at[length].pop()

    out = []
    while counts:
        first = max(counts)
        window = [pull(first)]
        window += [pull(x) for x in _take(capacity - first, counts)]
        out.append(window)
    return out


class WordIds:
    """Token ids of words that hold no blank, tab or line end.

    Where the vocabulary lowers the text and then cuts it by a pattern, words of plain Latin
    characters are lowered and cut here, all at once, and each distinct cut goes to the merge
    model once. All other words go through the whole tokenizer.

    The ids of words seen before stand in one table, in the order of ``seen``, so that a chunk
    costs a look-up and the work for its new words.
    """

    #: Printable characters below U+0180: composed already, each with one lower-case character
    #: (U+0130 has two and is left out), and no white space.
    PLAIN = r"^[\x21-\x7e\x{a1}-\x{ac}\x{ae}-\x{12f}\x{131}-\x{17f}]+$"

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.cuts: dict[str, bytes] = {"": b""}
        self.forget()
        self.pattern = cut_pattern(self.tokenizer)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_form = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xA1, 0x180)}

    def of_cuts(self, cuts: list[str]) -> list[bytes]:
        known, tokenize, form = self.cuts, self.model.tokenize, self.byte_form
        if len(known) > CACHE_WORDS:
            known = self.cuts = {"": b""}
        for x in cuts:
            if x not in known:
                ids = [t.id for t in tokenize(x if x.isascii() else x.translate(form))]
                known[x] = struct.pack(f"<{len(ids)}I", *ids)
        return [known[x] for x in cuts]

    def of_words(self, words: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch(words, add_special_tokens=False)
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in encoded]

    def forget(self) -> None:
        self.seen, self.table, self.at = pa.array([], pa.large_string()), np.empty(0, np.uint32), np.zeros(1, np.int64)

    def __call__(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct ``words`` in a row, and where each word's begin (and the last end)."""
        if len(self.seen) + len(words) > CACHE_WORDS:
            self.forget()
        place = pc.index_in(words, value_set=self.seen)
        unseen = words.filter(pc.is_null(place))
        if len(unseen):
            table, at = self.encoded(unseen)
            place = pc.fill_null(place, -1).to_numpy(zero_copy_only=False).astype(np.int64)
            place[place < 0] = len(self.seen) + np.arange(len(unseen))
            self.seen = pa.concat_arrays([self.seen, unseen])
            self.table, self.at = np.concatenate((self.table, table)), np.concatenate((self.at, self.at[-1] + at[1:]))
        return gather(self.table, self.at, np.asarray(place))

    def encoded(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct ``words`` in a row, and where each word's begin (and the last end)."""
        plain = np.zeros(len(words), bool)
        if self.pattern:
            plain = pc.match_substring_regex(words, self.PLAIN)
            for text in self.added:
                plain = pc.and_not(plain, pc.match_substring(words, text, ignore_case=True))
            plain = plain.to_numpy(zero_copy_only=False)
        marked = pc.replace_substring_regex(pc.utf8_lower(words.filter(pa.array(plain))), f"({self.pattern or '.'})", r"\1 ")
        lists = pc.split_pattern(marked, " ")
        pieces = lists.flatten().dictionary_encode()
        one, reach = gather(*joined(self.of_cuts(pieces.dictionary.to_pylist())), pieces.indices.to_numpy())
        one_at = reach[np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))]
        two, two_at = joined(self.of_words(words.filter(pa.array(~plain)).to_pylist()))
        # Both kinds in one table, and from there in the order of the words.
        table, at = np.concatenate((one, two)), np.concatenate((one_at, one_at[-1] + two_at[1:]))
        place = np.empty(len(words), np.int64)
        place[plain] = np.arange(plain.sum())
        place[~plain] = np.arange(plain.sum(), len(words))
        return gather(table, at, place)


def cut_pattern(tokenizer) -> str | None:
    """The pattern whose matches are encoded one by one, if the steps before the model are
    NFC, blanks, lower case, a split that keeps the matches alone, and the byte alphabet."""
    steps = json.loads(tokenizer.to_str())
    before = [(x["type"], x.get("content")) for x in (steps["normalizer"] or {}).get("normalizers", [])]
    split = (steps["pre_tokenizer"] or {}).get("pretokenizers", [])
    if before != [("NFC", None), ("Replace", " "), ("Lowercase", None)] or [x["type"] for x in split] != ["Split", "ByteLevel"]:
        return None
    if split[0]["behavior"] != "Removed" or not split[0]["invert"] or split[1]["add_prefix_space"] or split[1]["use_regex"]:
        return None
    return split[0]["pattern"].get("Regex")


def joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all parts in a row, and where each part begins (and the last ends)."""
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    return np.frombuffer(b"".join(parts), "<u4"), np.concatenate(([0], np.cumsum(sizes)))


def gather(table: np.ndarray, at: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``table[at[i]:at[i + 1]]`` for each ``i`` of ``index`` in a row, and their places."""
    taken = np.diff(at)[index]
    reach = np.concatenate(([0], np.cumsum(taken)))
    return table[np.repeat(at[:-1][index] - reach[:-1], taken) + np.arange(reach[-1])], reach


def document_ids(texts: pa.Array, word_ids: WordIds, end_id: int) -> Iterator[np.ndarray]:
    """Token ids of each text, ``CHUNK_BYTES`` of text (or one text) at a time: the distinct words
    of a chunk are encoded once and their ids gathered by position."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    starts = np.flatnonzero(np.diff(ends // CHUNK_BYTES, prepend=-1)) if len(texts) else []
    for at, to in zip(starts, [*starts[1:], len(texts)]):
        part = pc.fill_null(texts.slice(at, to - at), "")
        for blank in "\n\t\r":
            part = pc.replace_substring(part, blank, " ")
        lists = pc.split_pattern(part, " ")
        words = lists.flatten().dictionary_encode()
        flat, reach = gather(*word_ids(words.dictionary), words.indices.to_numpy())
        bounds = reach[np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy())))]
        for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            yield np.append(flat[start:stop], np.uint32(end_id))


def token_pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens)``: full windows and one remainder a document.

    The vocabulary's splitting never joins characters across a blank or line end, so words
    between those are encoded once and looked up afterwards (``CACHE_WORDS`` and those
    of one chunk at most). The table of ids lives in the value of an empty broadcast, which a worker process
    keeps from one task to the next.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kept = docs.sparkSession.sparkContext.broadcast({})

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        held = kept.value
        word_ids = held.get("words") or held.setdefault("words", WordIds(vocabulary))
        for batch in batches:
            ids, rows = batch.column("doc_id"), ([], [], [], [], [])
            for k, body in enumerate(document_ids(batch.column("text").cast(pa.large_string()), word_ids, end_id)):
                total = len(body)
                for start in range(0, total, capacity):
                    part = body[start : start + capacity]
                    for column, value in zip(rows, (k, start, len(part), zlib.crc32(part), total)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows[0], pa.int64())), *[pa.array(c, pa.int64()) for c in rows[1:]]],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(pieces, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens."""
    with small_batches(pieces.sparkSession):
        pieces = cut(pieces)
    shards = max(1, -(-pieces.count() // shard_pieces))
    # The place in the checkpoint deals out rows that are equal in everything.
    salted = F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens", F.monotonically_increasing_id())
    keyed = pieces.withColumn("shard", F.pmod(salted, F.lit(shards)))
    schema = keyed.drop("shard").limit(0).withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def fill(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        lengths = table.column("length").to_pylist()
        base, order, sequence, offset = key[0].as_py() << 32, [], [], []
        for n, window in enumerate(minimum_bin_slack(lengths, capacity)):
            at = 0
            for i in window:
                order.append(i)
                sequence.append(base + n)
                offset.append(at)
                at += lengths[i]
        out = table.drop_columns(["shard"]).take(pa.array(order, pa.int64()))
        return out.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    return keyed.groupBy("shard").applyInArrow(fill, schema)
