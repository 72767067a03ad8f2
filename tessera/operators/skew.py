"""Hot keys: found by a mergeable sketch, dealt into pieces, and grouped in bounded chunks.

A key that holds a large share of all rows would be one task of any shuffle by that key. Here the
heavy keys are found first, by a frequent-items sketch that every map task fills for itself
and that merges into a few thousand counters; each heavy key is then dealt into pieces by a hash of
its rows, so that the shuffle is by (key, piece) and no piece is more than a small part of
an average partition. None of it depends on adaptive skew handling.

The piece of a row follows from the leading digits of the md5 of its order key, so rows of one
key that are sorted by that hash are also sorted by piece. That gives every row an exact rank inside its
key without a task that sees the whole key (:func:`ranked`), and from the ranks
chunks of at most ``size`` rows (:func:`chunked`) that do not depend on how the rows were dealt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A piece of a heavy key is aimed at one part in so many of an average partition.
FINENESS = 16
#: Most heavy keys that are dealt into pieces; a key below the largest of these is light.
MOST_HEAVY = 20_000
#: Pieces are told apart by this many leading hexadecimal digits of the hash.
HASH_DIGITS = 4
MOST_PIECES = 16**HASH_DIGITS
CHUNK = 1024


def heavy_keys(rows: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """``(heavy, pieces)``: keys with more than a quarter of an average partition, and in how many pieces
    (a power of two) they are dealt.

    At most ``2 * partitions`` and at most ``MOST_HEAVY`` rows, whatever the size of the table. A null
    key is never heavy. The counts are the sketch's estimates: an error changes the
    number of pieces, not a result.
    """
    parts = partitions or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(16, min(MOST_HEAVY, 2 * parts))
    # No filter of null keys before the sketch: it would be pushed below a parser and run it twice.
    sketch = rows.agg(F.expr(f"approx_top_k(`{key}`, {most}, {min(1_000_000, 16 * most)})").alias("top"), F.count(key).alias("total"))
    found = sketch.select("total", F.inline("top")).toDF("total", "heavy", "seen").where(F.col("heavy").isNotNull())
    share = F.col("seen") * parts / F.col("total")  # in average partitions
    pieces = F.least(F.lit(MOST_PIECES), F.pow(F.lit(2.0), F.ceil(F.log2(share * FINENESS))).cast("int"))
    return found.where((share > 0.25) & (F.col("total") >= parts)).select("heavy", pieces.alias("pieces"))


def order_hash(identity: Column) -> Column:
    """The md5 by which the rows of a key are dealt and sorted, as hexadecimal digits."""
    return F.md5(F.coalesce(identity.cast("string"), F.lit("")).cast("binary"))


def piece_of(hashed: Column, pieces: Column) -> Column:
    """The piece of a row: its hash, scaled; 0 for a light key (null ``pieces``)."""
    leading = F.conv(F.substring(hashed, 1, HASH_DIGITS), 16, 10).cast("int")
    return F.when(pieces.isNull(), 0).otherwise(F.floor(leading * pieces / F.lit(MOST_PIECES)).cast("int"))


def with_piece(rows: DataFrame, key: str, hashed: Column, heavy: DataFrame) -> DataFrame:
    """``rows`` with ``_piece`` and ``_pieces`` (1 for a light key); ``heavy`` is broadcast, it has at most ``MOST_HEAVY`` rows."""
    joined = rows.join(F.broadcast(heavy), F.col(key) == F.col("heavy"), "left")
    dealt = {"_piece": piece_of(hashed, F.col("pieces")), "_pieces": F.coalesce("pieces", F.lit(1))}
    return joined.withColumns(dealt).drop("heavy", "pieces")


def salted_join(one: DataFrame, one_key: str, many: DataFrame, many_key: str, identity: Column, partitions: int | None = None) -> DataFrame:
    """Inner equi-join of ``one`` (few rows a key) with ``many`` (hot keys), as a sort-merge join by (key, piece).

    Rows of ``many`` go to the piece of their ``identity``; rows of ``one`` with a heavy key are
    repeated for each of its pieces. The columns of both sides follow, ``_piece`` and ``_pieces``.
    """
    heavy = heavy_keys(many.select(many_key), many_key, partitions)
    right = with_piece(many, many_key, order_hash(identity), heavy)
    spread = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("pieces"), F.lit(1)) - 1)).alias("_one_piece")
    left = one.join(F.broadcast(heavy), F.col(one_key) == F.col("heavy"), "left").select(*one.columns, spread)
    return left.join(right.hint("merge"), (F.col(one_key) == F.col(many_key)) & (F.col("_one_piece") == F.col("_piece"))).drop("_one_piece")


def ranked(rows: DataFrame, key: str, hashed: str, order: Sequence[Column]) -> DataFrame:
    """``rows`` (with ``_piece`` and ``_pieces``) and their rank, from 0, inside the key by ``hashed`` and then ``order``.

    Ranks are counted inside a piece; the rows of the pieces before come from a count per
    piece, of which a key has at most ``MOST_PIECES``. Only rows of heavy keys are read for those counts.
    """
    inside = Window.partitionBy(key, "_piece").orderBy(F.col(hashed), *order)
    local = rows.withColumn("_at", F.row_number().over(inside) - 1)
    counts = rows.where(F.col("_pieces") > 1).groupBy(F.col(key).alias("_k"), F.col("_piece").alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    before = F.sum("_c").over(Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("_before", before).where(F.col("_before").isNotNull()).drop("_c")  # later pieces of heavy keys
    joined = local.join(offsets, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_piece") == F.col("_p")), "left")
    return joined.withColumn("_rank", F.col("_at") + F.coalesce("_before", F.lit(0))).drop("_at", "_k", "_p", "_before")


def chunked(
    rows: DataFrame, key: str, identity: str, fields: Sequence[str], size: int = CHUNK, name: str = "rows", keep: Sequence[str] = (), dealt: bool = False, partitions: int | None = None
) -> DataFrame:
    """Groups of ``rows`` by ``key`` as bounded lists: ``(key, *keep, chunk, name, n)``.

    ``name`` is an array of structs of ``fields`` with at most ``size`` entries. Chunk 0 holds the first
    ``size`` rows of a key, chunk 1 the next and so on, in the order of the md5 of ``identity``, then of
    ``identity`` and the other fields; so the chunks depend on the rows alone and only the last one of a key
    is not full. ``keep`` are columns that all rows of a key have in common. ``dealt`` says that ``_piece`` and
    ``_pieces`` are there already, by the same identity.
    """
    if size < 1:
        raise ValueError("a chunk holds at least one row")
    hashed = order_hash(F.col(identity))
    if not dealt:
        rows = with_piece(rows, key, hashed, heavy_keys(rows.select(key), key, partitions))
    order = [F.col(identity), *[F.col(c) for c in fields if c != identity]]
    placed = ranked(rows.withColumn("_hash", hashed), key, "_hash", order)
    entry = F.struct(F.col("_rank"), F.struct(*[F.col(c) for c in fields]).alias("entry"))
    lists = placed.groupBy(key, F.floor(F.col("_rank") / size).cast("long").alias("chunk")).agg(
        *[F.first(c).alias(c) for c in keep], F.sort_array(F.collect_list(entry)).alias("_list"), F.count(F.lit(1)).alias("n")
    )
    return lists.select(key, *keep, "chunk", F.transform("_list", lambda e: e["entry"]).alias(name), "n")
