"""Loop-free operators applied to a streaming source give the batch result."""

from __future__ import annotations

import os

from tessera.operators import language_article_pairs, rank_langs_reduce
from tessera.sources import parse_articles


def test_rank_on_a_stream_of_article_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    batches = [
        [("1", "Scala and Java"), ("2", "Java only")],
        [("3", "Scala again"), ("4", "nothing here")],
    ]
    for i, batch in enumerate(batches):
        with open(os.path.join(src, f"part-{i}.txt"), "w") as f:
            for title, text in batch:
                f.write(f"<page> <title>{title}</title><text>{text}</text>  </page>\n")
    langs = ["Scala", "Java", "Perl"]
    stream = parse_articles(spark.readStream.schema("value string").text(src))
    ranked = rank_langs_reduce(stream, langs)
    query = (
        ranked.writeStream.outputMode("complete")
        .format("memory")
        .queryName("ranked_stream")
        .option("checkpointLocation", os.path.join(tmp_dir, "ckpt"))
        .start()
    )
    try:
        query.processAllAvailable()
        got = [(r.lang, r.n) for r in spark.sql("SELECT * FROM ranked_stream").collect()]
    finally:
        query.stop()
    assert got == [("Java", 2), ("Scala", 2)]

    pairs = language_article_pairs(stream, langs)
    q2 = (
        pairs.writeStream.outputMode("append")
        .format("memory")
        .queryName("pairs_stream")
        .option("checkpointLocation", os.path.join(tmp_dir, "ckpt2"))
        .start()
    )
    try:
        q2.processAllAvailable()
        rows = sorted(tuple(r) for r in spark.sql("SELECT * FROM pairs_stream").collect())
    finally:
        q2.stop()
    assert rows == [("Java", "1"), ("Java", "2"), ("Scala", "1"), ("Scala", "3")]
