"""Results do not depend on how the input is partitioned (1 vs 7 partitions)."""

from __future__ import annotations

from tessera.operators import (
    classified_columns,
    cluster_results,
    kmeans,
    sample_per_language,
    scored_postings,
    take_centres,
    time_usage_grouped,
    time_usage_summary,
)
from tessera.plans import bindings as B

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_clustering_independent_of_partitioning(spark):
    vectors = B.vectors(spark, SF)
    results = []
    for n in (1, 7):
        v = vectors.repartition(n)
        centres = take_centres(sample_per_language(v, B.TAG_TERMS, B.CLUSTER_KERNELS))
        km = kmeans(v, centres, eta=B.CLUSTER_ETA)
        results.append((centres, km.centres, rows(cluster_results(km.centres, v, B.TAG_TERMS, B.CLUSTER_SPREAD))))
    assert results[0] == results[1]


def test_scoring_independent_of_partitioning(spark):
    postings = B.postings(spark, SF)
    assert rows(scored_postings(postings.repartition(1))) == rows(scored_postings(postings.repartition(7)))


def test_survey_independent_of_partitioning(spark):
    survey = B.survey(spark, SF)
    out = []
    for n in (1, 7):
        df = survey.repartition(n)
        out.append([tuple(r) for r in time_usage_grouped(time_usage_summary(*classified_columns(df.columns), df)).collect()])
    assert out[0] == out[1]
