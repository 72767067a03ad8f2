"""The three main flows from files, with the default constants."""

from __future__ import annotations

import os

from tessera.constants import LANGUAGES
from tessera.programs import cluster_posting_file, rank_article_file, time_usage_by_life_period


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_rank_article_file(spark, tmp_dir):
    texts = ["Scala and Java run on the JVM", "Java is for enterprise developers", "C++ and C# and Java", "Python, not Python"]
    body = "".join(f"<page> <title>a{i}</title><text>{t}</text>  </page>\n" for i, t in enumerate(texts))
    r = rank_article_file(spark, write(os.path.join(tmp_dir, "articles.dat"), body))
    naive = [(x.lang, x.n) for x in r.naive.collect()]
    assert len(naive) == len(LANGUAGES)
    # "Python," is not "Python", but the second token is; ties in reverse vocabulary order.
    assert naive[:5] == [("Java", 3), ("Scala", 1), ("C++", 1), ("C#", 1), ("Python", 1)]
    assert all(n == 0 for _, n in naive[5:])
    assert [(x.lang, x.n) for x in r.using_index.collect()] == naive[:5]
    assert [(x.lang, x.n) for x in r.reduce.collect()] == naive[:5]


def test_cluster_posting_file_with_default_constants(spark, tmp_dir, capsys):
    lines = []
    for li, lang in enumerate(LANGUAGES):
        for q in range(8):
            qid = li * 100 + q
            lines.append(f"1,{qid},,,0,{lang}")
            lines.append(f"2,{100000 + qid},,{qid},{(q * 13 + li * 7) % 50}")
    out = cluster_posting_file(spark, write(os.path.join(tmp_dir, "postings.csv"), "\n".join(lines) + "\n"), debug=True)
    assert len(out.kmeans.centres) == 45
    assert "step 1:" in capsys.readouterr().out
    results = out.results.collect()
    assert sum(r.cluster_size for r in results) == 8 * len(LANGUAGES)
    assert {r.lang for r in results} <= set(LANGUAGES)
    assert len(out.report.collect()) == len(results)


def test_time_usage_by_life_period(spark, tmp_dir):
    header = "tucaseid,telfs,tesex,teage,t010101,t050101,t020101\n"
    rows = "1,1,1,20,480,300,60\n2,1,1,21,420,240,120\n3,5,2,40,500,0,0\n"
    got = [tuple(r) for r in time_usage_by_life_period(spark, write(os.path.join(tmp_dir, "survey.csv"), header + rows)).collect()]
    assert got == [("working", "male", "young", 7.5, 4.5, 1.5)]
