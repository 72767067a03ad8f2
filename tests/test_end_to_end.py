"""The three programs end to end, from files on disk."""

from __future__ import annotations

import os

from tessera.operators import (
    classified_columns,
    cluster_report,
    cluster_results,
    kmeans,
    make_index,
    question_vectors,
    rank_langs,
    rank_langs_reduce,
    rank_langs_using_index,
    sample_per_language,
    take_centres,
    time_usage_grouped,
    time_usage_grouped_sql,
    time_usage_summary,
)
from tessera.sources import parse_articles, parse_postings, read_lines, read_survey


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_ranking_from_an_article_file(spark, tmp_dir):
    articles = [("oak", "leaf bark root leaf"), ("fern", "leaf root"), ("moss", "damp, root"), ("stone", "grey")]
    body = "".join(f"<page> <title>{t}</title><text>{x}</text>  </page>\n" for t, x in articles)
    lines = read_lines(spark, write(os.path.join(tmp_dir, "articles.dat"), body))
    parsed = parse_articles(lines)
    langs = ["bark", "damp", "leaf", "root", "grey"]
    full = [(r.lang, r.n) for r in rank_langs(parsed, langs).collect()]
    assert full == [("root", 3), ("leaf", 2), ("grey", 1), ("bark", 1), ("damp", 0)]
    assert [(r.lang, r.n) for r in rank_langs_using_index(make_index(parsed, langs), langs).collect()] == full[:-1]
    assert [(r.lang, r.n) for r in rank_langs_reduce(parsed, langs).collect()] == full[:-1]


def test_clustering_from_a_posting_file(spark, tmp_dir, capsys):
    rows = []
    qid = 0
    for tag_index, tag in enumerate(["java", "sql"]):
        for i in range(30):
            qid += 1
            rows.append(f"1,{qid},,,0,{tag}")
            for j in range(i % 3 + 1):
                rows.append(f"2,{1000 + qid * 10 + j},,{qid},{(i * 7 + j * 5) % 40 - 10 + tag_index * 50}")
    rows.append("1,9999,,,0,go")  # unanswered question with a tag outside the vocabulary
    postings = parse_postings(read_lines(spark, write(os.path.join(tmp_dir, "postings.csv"), "\n".join(rows) + "\n")))
    langs = ["java", "sql"]
    vectors = question_vectors(postings, langs, 50000)
    assert vectors.count() == 60
    centres = take_centres(sample_per_language(vectors, langs, 4))
    result = kmeans(vectors, centres, eta=20.0, max_iterations=120, debug=True)
    assert result.converged
    assert "step 1:" in capsys.readouterr().out
    report = cluster_results(result.centres, vectors, langs, 50000).collect()
    assert sum(r.cluster_size for r in report) == 60
    assert [r.median_score for r in report] == sorted(r.median_score for r in report)
    lines = [r.line for r in cluster_report(cluster_results(result.centres, vectors, langs, 50000)).collect()]
    assert all(len(line) == len(lines[0]) for line in lines)


def test_survey_from_a_csv_file(spark, tmp_dir):
    header = "tucaseid,telfs,tesex,teage,t010101,t030101,t050101,t1805011,t020101,t180201,t500101\n"
    data = [
        "1,1,1,20,480,30,300,20,60,10,5",
        "2,2,2,40,500,40,0,0,120,0,5",
        "3,4,1,70,550,60,0,0,300,30,5",
        "4,5,2,30,400,60,400,0,100,0,5",
    ]
    columns, df = read_survey(spark, write(os.path.join(tmp_dir, "survey.csv"), header + "\n".join(data) + "\n"))
    primary, work, other = classified_columns(columns)
    assert (primary, work, other) == (["t030101", "t010101"], ["t1805011", "t050101"], ["t180201", "t020101"])
    summary = time_usage_summary(primary, work, other, df)
    grouped = [tuple(r) for r in time_usage_grouped(summary).collect()]
    assert grouped == [
        ("not working", "male", "elder", 10.2, 0.0, 5.5),
        ("working", "female", "active", 9.0, 0.0, 2.0),
        ("working", "male", "young", 8.5, 5.3, 1.2),
    ]
    assert [tuple(r) for r in time_usage_grouped_sql(summary).collect()] == grouped
