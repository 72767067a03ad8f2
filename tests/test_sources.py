"""Readers and parsers: articles, postings, lines, survey CSV."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException

from tessera.sources import parse_articles, parse_postings, read_lines, read_survey, survey_typed

POSTING_LINES = [
    "1,1,,,5,java",
    "1,2,12,,0,sql",
    "1,3,,,1,java",
    "1,4,,,1",
    "2,11,,1,-2",
    "2,12,,2,7",
    "2,13,,1,-1",
    "2,14,,4,9",
    "2,15,,99,3",
    "5,16,,,0",
]


def lines_df(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def article_line(title, text):
    return f"<page> <title>{title}</title><text>{text}</text>  </page>"


def test_read_lines_and_missing_path(spark, tmp_dir):
    path = os.path.join(tmp_dir, "lines.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write("first line\nsecond, line\nété\n")
    assert [r.value for r in read_lines(spark, path).collect()] == ["first line", "second, line", "été"]
    with pytest.raises(AnalysisException):
        read_lines(spark, os.path.join(tmp_dir, "missing.txt")).collect()


def test_parse_articles_fixed_offsets(spark):
    lines = [article_line("Scala", "Scala is a language"), article_line("", ""), article_line("a</title>b", "x y")]
    got = [tuple(r) for r in parse_articles(lines_df(spark, lines)).collect()]
    assert got == [("Scala", "Scala is a language"), ("", ""), ("a</title>b", "x y")]


def test_parse_articles_keeps_first_separator_and_newlines(spark):
    line = article_line("T", "one\ntwo</title><text>three")
    (row,) = parse_articles(lines_df(spark, [line])).collect()
    assert row.title == "T"
    assert row.text == "one\ntwo</title><text>three"


@pytest.mark.parametrize("bad", ["no separator at all", "<p></title><text>x</text>  </page>", "<page> <title>t</title><text>"])
def test_parse_articles_malformed_line_fails(spark, bad):
    with pytest.raises(Exception, match="malformed article line"):
        parse_articles(lines_df(spark, [bad])).collect()


def test_parse_articles_check_survives_column_pruning(spark):
    with pytest.raises(Exception, match="malformed article line"):
        parse_articles(lines_df(spark, ["broken"])).select("text").collect()


def test_parse_postings_fixture(spark):
    rows = parse_postings(lines_df(spark, POSTING_LINES)).collect()
    assert len(rows) == 10
    by_id = {r.id: r for r in rows}
    assert tuple(by_id[1]) == (1, 1, None, None, 5, "java")
    assert tuple(by_id[2]) == (1, 2, 12, None, 0, "sql")
    assert by_id[4].tags is None
    assert tuple(by_id[11]) == (2, 11, None, 1, -2, None)
    assert by_id[16].posting_type == 5
    assert sum(r.posting_type == 1 for r in rows) == 4
    assert sum(r.posting_type == 2 for r in rows) == 5


def test_parse_postings_ignores_fields_past_the_sixth(spark):
    (row,) = parse_postings(lines_df(spark, ["1,7,,,3,scala,extra,more"])).collect()
    assert tuple(row) == (1, 7, None, None, 3, "scala")


@pytest.mark.parametrize("bad", ["2,29,,27,", "x,1,,,0", "1,2", "1,2,abc,,0", "1,2,,,"])
def test_parse_postings_malformed_fails(spark, bad):
    with pytest.raises(Exception, match="malformed"):
        parse_postings(lines_df(spark, [bad])).collect()


def test_parse_postings_fails_whatever_the_ansi_setting(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="malformed score"):
            parse_postings(lines_df(spark, ["1,2,,,x"])).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_read_survey_takes_types_from_the_header_and_returns_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "survey.csv")
    with open(path, "w") as f:
        f.write("tucaseid,telfs,tesex,teage,t010101,t050101\n")
        f.write("20030100013280,2,1,22,60,120\n")
        f.write("20030100013344,4,2,23,0,30\n")
    columns, df = read_survey(spark, path)
    assert columns == ["tucaseid", "telfs", "tesex", "teage", "t010101", "t050101"]
    assert dict(df.dtypes)["telfs"] == "int"
    assert df.count() == 2
    columns2, df2 = read_survey(spark, path, schema="tucaseid string, telfs int, tesex int, teage int, t010101 int, t050101 int")
    assert columns2 == columns
    assert df2.collect() == df.withColumn("tucaseid", df.tucaseid.cast("string")).collect()
    inferred = spark.read.csv(path, header=True, inferSchema=True)
    assert df.dtypes == inferred.dtypes and df.collect() == inferred.collect()


def test_read_survey_scans_the_file_once(spark, tmp_dir, monkeypatch):
    path = os.path.join(tmp_dir, "survey.csv")
    with open(path, "w") as f:
        f.write('tucaseid,"telfs",tesex,teage,t010101,tufnwgtp\n')
        f.write("1,2,1,22,60,8155462.672158\n2,,2,30,0,1\n")
    kind, lines = type(spark.range(1)), []
    head = kind.head
    monkeypatch.setattr(kind, "head", lambda df, *n: lines.append(df.columns) or head(df, *n))
    columns, df = read_survey(spark, path)
    assert lines == [["value"]]  # the header line is all that was read
    assert columns == ["tucaseid", "telfs", "tesex", "teage", "t010101", "tufnwgtp"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert [tuple(r) for r in df.collect()] == [(1, 2, 1, 22, 60, 8155462.672158), (2, None, 2, 30, 0, 1.0)]
    with open(path, "a") as f:
        f.write("3,2,1,22,sixty,1\n")
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        read_survey(spark, path)[1].collect()
    empty = os.path.join(tmp_dir, "empty.csv")
    open(empty, "w").close()
    with pytest.raises(ValueError, match="no header"):
        read_survey(spark, empty)


def test_survey_typed(spark):
    df = spark.createDataFrame([("a", "1", " 2.5 "), ("b", None, "3")], "id string, x string, y string")
    rows = survey_typed(df).collect()
    assert survey_typed(df).dtypes == [("id", "string"), ("x", "double"), ("y", "double")]
    assert [tuple(r) for r in rows] == [("a", 1.0, 2.5), ("b", None, 3.0)]
    bad = spark.createDataFrame([("a", "one")], "id string, x string")
    with pytest.raises(Exception, match="malformed number"):
        survey_typed(bad).collect()


def test_parse_articles_with_other_offsets(spark):
    # Lines without the padding: 13-character prefix, 14-character tail.
    line = "<page><title>Scala</title><text>Scala is a language</text></page>"
    (row,) = parse_articles(lines_df(spark, [line]), title_offset=13, tail=14).collect()
    assert tuple(row) == ("Scala", "Scala is a language")
