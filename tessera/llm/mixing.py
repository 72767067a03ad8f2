"""Mixing sources to target weights.

Word counts are summed per source, each source's target gives its repetition rate, and
every document is taken ``floor(rate)`` times plus one more time with a probability equal to
the fraction, decided by a hash.

The extra copies are a systematic sample along the sizes, so that a source's words come near its target
while every document keeps its probability. The documents of a source stand in order of size; with
a start between 0 and 1 from the hash of the source's name, ``n`` documents have
``floor(start + n * fraction)`` extra copies in all. That gives the number of copies of each size, and of the
documents of a size those with the smallest draws get them. A document's draw is fixed by its id and text.

Gathered are sums per source, counts per source and size, and counts per source, size and draw (all
combined map-side, so a source, a size or a repeated row with a third of all rows costs one row per
task). The smallest draws of a size are found by counting ranges of draws first, so no task
sorts all documents of a size. How tables are joined is Spark's own choice by their size.

Results for special rows: a null text has size 0; a null source is a source of its own
and comes last in the order of weights; a null id draws by its text; repeated rows get
equal draws, and so one extra copy each or none; an empty table gives no rows; a source without words
has target 0; other columns are carried by :func:`mix_documents` and clash with none of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, same

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
#: Draws are integers below 2**52, counted by their leading bits first.
DRAWS = 1 << 52
RANGE_BITS = 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column) -> Column:
    """A uniform integer below ``DRAWS`` from the id and the text."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """Targets of ``sources(source, source_size)``: shares of the total by weight, at most
    ``max_rate`` times a source's size, the excess shared again by weight.

    The capped sources are those first in the order of size by weight, so running sums in
    that order give the final shares at once. One row per source goes into the window.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights)) + 1)
    s = sources.select("source", "source_size", w.cast("long").alias("weight"))
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("ratio", F.lit(float(max_rate)) * F.col("source_size") / F.col("weight"))
    s = s.select(
        "*",
        (F.sum("source_size").over(everything) - max_rate * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left_size"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("left_weight"),
    )
    s = s.withColumn("level", F.col("left_size") / F.col("left_weight"))
    # The first source in this order whose cap is not reached sets the level for all after it.
    s = s.withColumn("final", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "source", "level"))).over(everything))
    open_ = F.coalesce(F.col("ratio") >= F.col("final.ratio"), F.lit(False))
    target = F.when(open_, F.col("weight") * F.col("final.level")).otherwise(F.lit(float(max_rate)) * F.col("source_size"))
    return s.select("source", "source_size", F.least(target, F.lit(float(max_rate)) * F.col("source_size")).alias("target"))


def start_of(source: Column) -> Column:
    """Where a source's systematic sample starts, at least 0 and below 1, by the hash of its name."""
    return draw(F.lit("start"), source).cast("double") / F.lit(float(DRAWS))


def mixing_plan(rows: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """``(source, size, source_size, target, whole, last)`` for ``rows(source, size, u)``: documents of
    that source and size are taken ``whole`` times, and once more if their draw is at most ``last``."""
    counts = cut(rows.groupBy("source", "size", "u").agg(F.count(F.lit(1)).alias("c")))
    sizes = cut(counts.groupBy("source", "size").agg(F.sum("c").alias("m")))
    sources = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    targets = source_targets(sources, weights, max_rate)
    targets = targets.withColumn("rate", F.coalesce(F.least(F.try_divide("target", "source_size"), F.lit(float(max_rate))), F.lit(0.0)))
    targets = cut(targets.withColumns({"whole": F.floor("rate"), "start": start_of(F.col("source"))}))

    before = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    plan = attach(sizes.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0))), targets, ["source"])
    share = F.col("rate") - F.col("whole")

    def copies_of(n: Column) -> Column:
        return F.floor(F.col("start") + n * share)

    plan = cut(plan.withColumn("q", copies_of(F.col("before") + F.col("m")) - copies_of(F.col("before"))))

    # The q-th smallest draw of each size: first the range of draws that holds it, then the draw.
    cell = ["source", "size"]
    width = F.lit(DRAWS >> RANGE_BITS)
    partly = plan.filter("q > 0 AND q < m").select("source", "size", "q")
    inside = attach(counts, partly, cell).withColumn("part", F.floor(F.col("u") / width))
    ranges = inside.groupBy(*cell, "q", "part").agg(F.sum("c").alias("c"))
    ranges = ranges.withColumn("upto", F.sum("c").over(Window.partitionBy(*cell).orderBy("part")))
    holding = ranges.filter((F.col("upto") >= F.col("q")) & (F.col("upto") - F.col("c") < F.col("q")))
    holding = holding.select(*cell, "part", (F.col("q") - (F.col("upto") - F.col("c"))).alias("left"))
    near = attach(inside.drop("q"), holding, [*cell, "part"])
    near = near.withColumn("upto", F.sum("c").over(Window.partitionBy(*cell).orderBy("u")))
    last = near.filter("upto >= left").groupBy(*cell).agg(F.min("u").alias("last"))
    plan = attach(plan, last, cell, "left")
    last = F.when(F.col("q") <= 0, -1).when(F.col("q") >= F.col("m"), DRAWS).otherwise(F.col("last"))
    return cut(plan.select("source", "size", "source_size", "target", "whole", last.cast("long").alias("last")))


def attach(rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join the columns of ``table`` to rows by ``keys``, null-safely."""
    table = table.withColumnsRenamed({k: f"__{k}" for k in keys})
    joined = rows.join(table, [same(F.col(k), F.col(f"__{k}")) for k in keys], how)
    return joined.drop(*[f"__{k}" for k in keys])


def _copies() -> Column:
    return (F.col("whole") + (F.col("u") <= F.col("last")).cast("long")).cast("long")


def mix_sizes(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken`` and its ``copies``."""
    rows = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("u")))
    mixed = attach(rows, mixing_plan(rows, weights, max_rate), ["source", "size"]).withColumn("copies", _copies())
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    drawn = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "source",
        word_count(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("u"),
    )
    plan = mixing_plan(cut(drawn.drop("row")), weights, max_rate)
    mixed = attach(drawn, plan, ["source", "size"]).select("row", _copies().alias("copies")).filter("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


MIX_SQL = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 13) AS BIGINT) AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
r AS (SELECT *, 3.0::DOUBLE * source_size / weight AS ratio FROM w),
l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
  FROM r WINDOW b AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT ratio AS final_ratio, level AS final_level FROM l WHERE ratio >= level ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size, least(CASE WHEN ratio >= final_ratio THEN weight * final_level ELSE 3.0::DOUBLE * source_size END,
                                    3.0::DOUBLE * source_size) AS target
  FROM l LEFT JOIN f ON true),
p AS (SELECT *, coalesce(CASE WHEN source_size > 0 THEN least(target / source_size, 3.0::DOUBLE) END, 0.0::DOUBLE) AS rate,
             CAST('0x' || substr(md5('start:' || coalesce(source, '')), 1, 13) AS BIGINT)::DOUBLE / {DRAWS}.0::DOUBLE AS start FROM t),
m AS (SELECT source, size, count(*) AS m FROM d GROUP BY source, size),
b AS (SELECT *, coalesce(sum(m) OVER (PARTITION BY source ORDER BY size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM m),
q AS (
  SELECT b.source, b.size, p.source_size, p.target, floor(rate)::BIGINT AS whole,
         floor(start + (before + m) * (rate - floor(rate))) - floor(start + before * (rate - floor(rate))) AS q
  FROM b JOIN p ON b.source IS NOT DISTINCT FROM p.source),
z AS (SELECT *, rank() OVER (PARTITION BY source, size ORDER BY u) AS k FROM d)
SELECT z.doc_id, z.size, q.source_size, q.target, (z.size * (whole + CASE WHEN k <= q.q THEN 1 ELSE 0 END))::BIGINT AS taken
FROM z JOIN q ON z.source IS NOT DISTINCT FROM q.source AND z.size = q.size
"""
