"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of a fixed number of UTF-8 bytes. Distinct blocks are
sorted, and a block's place in that order is its integer name. Adjacent names are then
paired, the distinct pairs are sorted and named in the same way, and so on until one
name is left for each document. Names are given to contents, never to hashes: two texts
get the same final name if and only if they are equal.

* Sorting runs in ``NAME_BUCKETS`` slices of a 64-bit hash of the content; inside a slice
  the order is (hash, content), so the name ``place * NAME_BUCKETS + slice`` depends on the
  contents alone, not on partitions or on the order in which rows arrive.
* Block contents travel once, after map-side combination (a block that fills a third of
  all rows leaves one row per task). Contents that share a 64-bit hash are told apart by
  their bytes; only if such contents exist do the bytes join the join condition.
* Later levels move integers only, and halve in size.

Results for special rows: a null text equals the empty text; a null id is an ordinary
value that loses against any other id of its group; rows repeated with the same id and
text are all returned, and only one of them can be kept; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, same, text_bytes

BLOCK_BYTES = 4096
NAME_BUCKETS = 4096


def _ranked(df: DataFrame, hash_col: str, *order: str) -> Column:
    """Integer names by sorted order inside slices of the hash."""
    bucket = F.shiftrightunsigned(F.col(hash_col), 64 - (NAME_BUCKETS - 1).bit_length())
    w = Window.partitionBy(bucket).orderBy(hash_col, *order)
    return F.row_number().over(w).cast("long") * NAME_BUCKETS + bucket


def _blocks(size: int) -> Column:
    last = F.greatest(F.ceil(F.octet_length("body") / F.lit(size)), F.lit(1)) - 1
    return F.transform(
        F.sequence(F.lit(0).cast("long"), last),
        lambda i: F.expr("body").substr((i * size + 1).cast("int"), F.lit(size)),
    )


def name_documents(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One identity ``(depth, name)`` per distinct ``(id, sha)`` of ``rows(id, sha, body)``."""
    blocks = rows.select("id", "sha", F.posexplode(_blocks(block_bytes)).alias("idx", "block"), F.octet_length("body").alias("len"))
    blocks = blocks.select(
        "id", "sha", F.greatest(F.ceil(F.col("len") / F.lit(block_bytes)), F.lit(1)).alias("n"),
        F.col("idx").cast("long").alias("idx"), "block", F.xxhash64("block").alias("h"),
    )
    contents = blocks.groupBy("h").agg(F.array_sort(F.collect_set("block")).alias("contents"))
    contents = contents.select("h", (F.size("contents") > 1).alias("shared"), F.posexplode("contents").alias("v", "block"))
    names = cut(
        contents.withColumn("name", _ranked(contents, "h", "v"))
        .select("h", "name", F.when(F.col("shared"), F.col("block")).alias("content"))
    )
    if names.filter(F.col("content").isNotNull()).isEmpty():
        named = blocks.select("id", "sha", "n", "idx", "h").join(names.select("h", "name"), "h")
    else:
        fits = F.col("content").isNull() | (F.col("content") == F.col("block"))
        named = blocks.join(names, "h").filter(fits)
    current = cut(named.select("id", "sha", "n", "idx", "name"))

    depth, done = 0, []
    longest = current.agg(F.max("n")).first()[0] or 1
    while True:
        done.append(current.filter("n = 1").select("id", "sha", F.lit(depth).alias("depth"), "name"))
        if longest <= 1:
            break
        half = F.col("idx") % 2
        pairs = (
            current.filter("n > 1")
            .groupBy("id", "sha", "n", F.floor(F.col("idx") / 2).alias("pair"))
            .agg(F.max(F.when(half == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1)).alias("b"))
        )
        distinct = pairs.select("a", "b").distinct().withColumn("h", F.xxhash64("a", "b"))
        names = distinct.select("a", "b", _ranked(distinct, "h", "a", "b").alias("name"))
        current = cut(pairs.join(names, ["a", "b"]).select("id", "sha", F.ceil(F.col("n") / 2).alias("n"), F.col("pair").alias("idx"), "name"))
        longest, depth = -(-longest // 2), depth + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.distinct()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Group equal texts; the row with the largest id of each group stays.

    Returns one row per input row: the id column, ``keep_id``, ``group_size``, ``kept``
    and ``text_sha256`` (lowercase hex of the UTF-8 text).
    """
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("body"))
    rows = rows.select("id", "body", F.unhex(F.sha2("body", 256)).alias("sha"))
    documents = rows.groupBy("id", "sha").agg(F.count(F.lit(1)).alias("copies"))
    ident = name_documents(rows, block_bytes).select(F.col("id").alias("i_id"), F.col("sha").alias("i_sha"), "depth", "name")
    documents = cut(
        documents.join(ident, same(F.col("id"), F.col("i_id")) & (F.col("sha") == F.col("i_sha")))
        .select("id", "sha", "copies", "depth", "name")
    )
    groups = documents.groupBy("depth", "name").agg(F.max("id").alias("keep_id"), F.sum("copies").alias("group_size"))
    out = documents.join(groups, ["depth", "name"])
    return out.select(
        "id", "keep_id", "group_size", F.lower(F.hex("sha")).alias("text_sha256"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (same(F.col("id"), F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns.

    Repeated rows of one id and text count once; if they differ in other columns, any
    one of them stays.
    """
    def row_key(digest: Column) -> Column:
        return F.unhex(F.sha2(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).cast("binary"), F.lit(b":"), digest), 256))

    verdict = exact_dedup(docs, id_col, text_col, block_bytes).filter("kept")
    keys = verdict.select(row_key(F.unhex("text_sha256")).alias("__row"))
    tagged = docs.withColumn("__row", row_key(F.unhex(F.sha2(text_bytes(F.col(text_col)), 256))))
    # Join and de-duplication share one shuffle on the row key.
    return tagged.join(keys, "__row", "left_semi").dropDuplicates(["__row"]).drop("__row")
