"""DuckDB SQL oracle for every query key.

Each statement reads only the supplied tables (registered as views) and
restates its binding as CTEs. The formulations are deliberately independent
of the Spark code: postings are built straight from the tables instead of
parsed, scores are computed join-then-group, term matches use a
vocabulary cross product, the median uses cumulative counts, and k-means is
an unrolled chain of steps that stops changing once converged. The chain
raises an error, rather than answering, if it has not converged within its
unrolled steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..constants import CLUSTER_REPORT_FORMAT
from . import bindings as B

KMEANS_UNROLLED_STEPS = 8


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case_index(column: str, terms: Sequence[str]) -> str:
    whens = " ".join(f"WHEN {_q(t)} THEN {i}" for i, t in enumerate(terms))
    return f"CASE {column} {whens} END"


def _case_term(index_expr: str, terms: Sequence[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(t)}" for i, t in enumerate(terms))
    return f"CASE {index_expr} {whens} END"


def _dist(p: str, c: str, px: str = "x", py: str = "y", cx: str = "x", cy: str = "y") -> str:
    dx = f"(CAST({p}.{px} AS DOUBLE) - CAST({c}.{cx} AS DOUBLE))"
    dy = f"(CAST({p}.{py} AS DOUBLE) - CAST({c}.{cy} AS DOUBLE))"
    return f"({dx} * {dx} + {dy} * {dy})"


def _nearest(points: str, centres: str) -> str:
    """Each distinct point of ``points`` with its closest centre (ties: lowest pos)."""
    return (
        "SELECT * EXCLUDE (rn) FROM ("
        f" SELECT p.*, c.pos AS cpos, c.x AS cx, c.y AS cy,"
        f" row_number() OVER (PARTITION BY p.x, p.y ORDER BY {_dist('p', 'c')}, c.pos) AS rn"
        f" FROM {points} p CROSS JOIN {centres} c) WHERE rn = 1"
    )


class _Ctes:
    """Named CTEs with dependencies, rendered in dependency order."""

    def __init__(self) -> None:
        self.defs: dict[str, tuple[str, tuple[str, ...]]] = {}

    def add(self, name: str, sql: str, *deps: str) -> None:
        self.defs[name] = (sql, deps)

    def sql(self, body: str, *needs: str) -> str:
        order: list[str] = []

        def visit(n: str) -> None:
            if n in order:
                return
            for d in self.defs[n][1]:
                visit(d)
            order.append(n)

        for n in needs:
            visit(n)
        if not order:
            return body
        parts = ",\n".join(f"{n} AS (\n{self.defs[n][0]}\n)" for n in order)
        return f"WITH {parts}\n{body}"


def _build() -> dict[str, str]:
    C = _Ctes()
    terms = B.ARTICLE_TERMS
    tags = B.TAG_TERMS
    per_lang = B.CLUSTER_KERNELS // len(tags)

    # -- text ranking --------------------------------------------------------
    C.add("articles", "SELECT CAST(doc_id AS VARCHAR) AS title, text FROM documents")
    vocab_rows = ", ".join(f"({_q(t)}, {i})" for i, t in enumerate(terms, 1))
    C.add("vocab", f"SELECT * FROM (VALUES {vocab_rows}) AS v(lang, pos)")
    C.add(
        "pairs",
        "SELECT v.lang, v.pos, a.title, a.text FROM articles a JOIN vocab v"
        " ON list_contains(string_split(a.text, ' '), v.lang)",
        "articles",
        "vocab",
    )
    C.add("term_counts", "SELECT lang, COUNT(*) AS n FROM pairs GROUP BY lang", "pairs")

    # -- postings -------------------------------------------------------------
    C.add(
        "postings",
        "SELECT 1 AS posting_type, CAST(o_orderkey AS BIGINT) AS id, CAST(NULL AS BIGINT) AS accepted_answer,"
        " CAST(NULL AS BIGINT) AS parent_id, 0 AS score, NULLIF(o_orderpriority, '') AS tags FROM orders\n"
        "UNION ALL\n"
        "SELECT 2, CAST(l_orderkey * 10 + l_linenumber AS BIGINT), NULL, CAST(l_orderkey AS BIGINT),"
        " CAST(l_quantity AS INTEGER) - 25, NULL FROM lineitem",
    )
    C.add("questions", "SELECT * FROM postings WHERE posting_type = 1", "postings")
    C.add("answers", "SELECT * FROM postings WHERE posting_type = 2", "postings")
    cols = ("posting_type", "id", "accepted_answer", "parent_id", "score", "tags")
    pair_cols = ", ".join([f"q.{c} AS q_{c}" for c in cols] + [f"a.{c} AS a_{c}" for c in cols])
    C.add("qa_pairs", f"SELECT {pair_cols} FROM questions q JOIN answers a ON q.id = a.parent_id", "questions", "answers")
    qcols = ", ".join(f"q.{c}" for c in cols)
    C.add(
        "scored",
        f"SELECT {qcols}, GREATEST(MAX(a.score), 0) AS high_score"
        f" FROM questions q JOIN answers a ON q.id = a.parent_id GROUP BY {qcols}",
        "questions",
        "answers",
    )
    for name, spread in (("vectors", B.CLUSTER_SPREAD), ("vectors_small", B.SMALL_SPREAD)):
        C.add(
            name,
            f"SELECT CAST(idx * {spread} AS INTEGER) AS x, CAST(high_score AS INTEGER) AS y"
            f" FROM (SELECT {_case_index('tags', tags)} AS idx, high_score FROM scored) WHERE idx IS NOT NULL",
            "scored",
        )
    C.add("wv", "SELECT x, y, COUNT(*) AS n FROM vectors GROUP BY x, y", "vectors")
    C.add("dv", "SELECT DISTINCT x, y FROM vectors", "vectors")
    seed = B.CLUSTER_SEED
    C.add(
        "start",
        "SELECT CAST(row_number() OVER (ORDER BY x, h, y) - 1 AS INTEGER) AS pos, x, y FROM ("
        " SELECT x, y, h, row_number() OVER (PARTITION BY x ORDER BY h, y) AS rn FROM ("
        f"  SELECT x, y, md5(concat_ws('|', {seed}, x, y)) AS h FROM dv))"
        f" WHERE rn <= {per_lang}",
        "dv",
    )

    # -- k-means, unrolled ---------------------------------------------------
    eta = B.CLUSTER_ETA
    max_it = B.CLUSTER_MAX_ITERATIONS
    C.add("c0", "SELECT pos, x, y, FALSE AS done, 0 AS it FROM start", "start")
    for i in range(1, KMEANS_UNROLLED_STEPS + 1):
        prev = f"c{i - 1}"
        C.add(
            f"a{i}",
            "SELECT cx, cy, CAST(SUM(CAST(x AS HUGEINT) * n) // SUM(n) AS INTEGER) AS nx,"
            " CAST(SUM(CAST(y AS HUGEINT) * n) // SUM(n) AS INTEGER) AS ny"
            f" FROM ({_nearest('wv', prev)}) GROUP BY cx, cy",
            "wv",
            prev,
        )
        C.add(
            f"m{i}",
            "SELECT p.pos, p.x AS ox, p.y AS oy, p.done, p.it,"
            " CASE WHEN p.done THEN p.x WHEN a.nx IS NULL THEN error('empty cluster') ELSE a.nx END AS nx,"
            " CASE WHEN p.done THEN p.y WHEN a.ny IS NULL THEN error('empty cluster') ELSE a.ny END AS ny"
            f" FROM {prev} p LEFT JOIN a{i} a ON a.cx = p.x AND a.cy = p.y",
            prev,
            f"a{i}",
        )
        C.add(f"s{i}", f"SELECT SUM({_dist('m', 'm', 'nx', 'ny', 'ox', 'oy')}) AS dist FROM m{i} m", f"m{i}")
        C.add(
            f"c{i}",
            f"SELECT m.pos, m.nx AS x, m.ny AS y, m.done OR s.dist < {eta} OR m.it + 1 >= {max_it} AS done,"
            " CASE WHEN m.done THEN m.it ELSE m.it + 1 END AS it"
            f" FROM m{i} m CROSS JOIN s{i} s",
            f"m{i}",
            f"s{i}",
        )
    last = f"c{KMEANS_UNROLLED_STEPS}"
    C.add(
        "final",
        f"SELECT pos, x, y FROM {last}"
        " WHERE CASE WHEN done THEN TRUE ELSE error('k-means did not stop within the unrolled steps') END",
        last,
    )
    trace_parts = [
        f"SELECT m.it + 1 AS iter, m.pos, m.ox AS old_x, m.oy AS old_y, m.nx AS new_x, m.ny AS new_y,"
        f" {_dist('m', 'm', 'nx', 'ny', 'ox', 'oy')} AS distance, s.dist AS iter_distance"
        f" FROM m{i} m CROSS JOIN s{i} s WHERE NOT m.done"
        for i in range(1, KMEANS_UNROLLED_STEPS + 1)
    ]
    C.add("trace", "\nUNION ALL\n".join(trace_parts), *[f"s{i}" for i in range(1, KMEANS_UNROLLED_STEPS + 1)])

    # -- cluster results -------------------------------------------------------
    C.add("fa", _nearest("wv", "final"), "wv", "final")
    C.add("pt", "SELECT cx, cy, x, y, SUM(n) AS n FROM fa GROUP BY cx, cy, x, y", "fa")
    C.add("px", "SELECT cx, cy, x, SUM(n) AS cnt FROM pt GROUP BY cx, cy, x", "pt")
    C.add("sz", "SELECT cx, cy, SUM(cnt) AS size FROM px GROUP BY cx, cy", "px")
    C.add(
        "dom",
        "SELECT cx, cy, x, cnt FROM ("
        " SELECT *, row_number() OVER (PARTITION BY cx, cy ORDER BY cnt DESC, x) AS rn FROM px) WHERE rn = 1",
        "px",
    )
    C.add(
        "cum",
        "SELECT cx, cy, y, SUM(n) OVER (PARTITION BY cx, cy ORDER BY y"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto"
        " FROM (SELECT cx, cy, y, SUM(n) AS n FROM pt GROUP BY cx, cy, y)",
        "pt",
    )
    C.add(
        "med",
        "SELECT c.cx, c.cy,"
        " (MIN(c.y) FILTER (WHERE c.upto > (s.size - 1) // 2) + MIN(c.y) FILTER (WHERE c.upto > s.size // 2)) // 2"
        " AS median FROM cum c JOIN sz s ON c.cx = s.cx AND c.cy = s.cy GROUP BY c.cx, c.cy",
        "cum",
        "sz",
    )
    spread = B.CLUSTER_SPREAD
    C.add(
        "clusters",
        f"SELECT {_case_term(f'd.x // {spread}', tags)} AS lang,"
        " CAST((d.cnt * 100) // s.size AS DOUBLE) AS lang_percent,"
        " CAST(s.size AS BIGINT) AS cluster_size, CAST(m.median AS INTEGER) AS median_score"
        " FROM dom d JOIN sz s ON d.cx = s.cx AND d.cy = s.cy JOIN med m ON d.cx = m.cx AND d.cy = m.cy",
        "dom",
        "sz",
        "med",
    )

    # -- survey ----------------------------------------------------------------
    minute_cols = B.SURVEY_MINUTE_COLUMNS
    sums = ", ".join(
        f"SUM(CASE WHEN l_linenumber = {i} THEN l_quantity END) AS m{i}" for i in range(1, len(minute_cols) + 1)
    )
    minutes = ", ".join(f"CAST(COALESCE(m.m{i}, 0) AS INTEGER) AS {c}" for i, c in enumerate(minute_cols, 1))
    C.add(
        "survey",
        "SELECT CAST(o.o_orderkey AS VARCHAR) AS tucaseid, o.o_orderkey % 5 + 1 AS telfs,"
        f" o.o_custkey % 2 + 1 AS tesex, 15 + o.o_custkey % 60 AS teage, {minutes}"
        f" FROM orders o LEFT JOIN (SELECT l_orderkey, {sums} FROM lineitem GROUP BY l_orderkey) m"
        " ON o.o_orderkey = m.l_orderkey",
    )
    # Classes of the bound minute columns: t010101, t180301 primary; t050101,
    # t180501 work; t120101, t180201 other; t500101 none.
    C.add(
        "summary",
        "SELECT CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working,"
        " CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,"
        " CASE WHEN teage BETWEEN 15 AND 22 THEN 'young' WHEN teage BETWEEN 23 AND 55 THEN 'active'"
        " ELSE 'elder' END AS age,"
        " (t180301 + t010101) / 60 AS primaryNeeds, (t180501 + t050101) / 60 AS work,"
        " (t180201 + t120101) / 60 AS other"
        " FROM survey WHERE telfs <= 4",
        "survey",
    )
    C.add("ints", "SELECT CAST(l_quantity AS INTEGER) - 25 AS x FROM lineitem")

    grouped = (
        "SELECT working, sex, age, ROUND(AVG(primaryNeeds), 1) AS primaryNeeds,"
        " ROUND(AVG(work), 1) AS work, ROUND(AVG(other), 1) AS other"
        " FROM {src} GROUP BY working, sex, age ORDER BY working, sex, age"
    )
    C.add(
        "summary_typed",
        "SELECT working, sex, age, COALESCE(primaryNeeds, 0.0) AS primaryNeeds,"
        " COALESCE(work, 0.0) AS work, COALESCE(other, 0.0) AS other FROM summary",
        "summary",
    )
    classified = [
        ("primary", "t010101"), ("primary", "t180301"), ("work", "t050101"),
        ("work", "t180501"), ("other", "t120101"), ("other", "t180201"),
    ]
    classify_sql = "\nUNION ALL\n".join(
        f"SELECT {_q(k)} AS activity_class, {_q(c)} AS column_name, CAST(SUM({c}) AS BIGINT) AS minutes FROM survey"
        for k, c in classified
    )
    typed_cols = ", ".join(
        f"CAST(CAST({c} AS VARCHAR) AS DOUBLE) AS {c}" for c in ("telfs", "tesex", "teage", *minute_cols)
    )
    rank_order = "ORDER BY n DESC, pos DESC"
    fmt = CLUSTER_REPORT_FORMAT

    return {
        "parse_articles": C.sql("SELECT title, text FROM articles", "articles"),
        "mentions_filter": C.sql(
            f"SELECT title, text FROM articles WHERE list_contains(string_split(text, ' '), {_q(B.SINGLE_TERM)})",
            "articles",
        ),
        "occurrences_of_lang": C.sql(
            f"SELECT {_q(B.SINGLE_TERM)} AS lang,"
            f" COUNT(*) FILTER (WHERE list_contains(string_split(text, ' '), {_q(B.SINGLE_TERM)})) AS n FROM articles",
            "articles",
        ),
        "language_article_pairs": C.sql("SELECT lang, title FROM pairs", "pairs"),
        "make_index": C.sql("SELECT lang, title, text FROM pairs", "pairs"),
        "rank_langs": C.sql(
            f"SELECT v.lang, COALESCE(c.n, 0) AS n FROM vocab v LEFT JOIN term_counts c ON v.lang = c.lang"
            f" ORDER BY n DESC, v.pos DESC",
            "vocab",
            "term_counts",
        ),
        "rank_langs_using_index": C.sql(
            f"SELECT c.lang, c.n FROM term_counts c JOIN vocab v ON c.lang = v.lang {rank_order}",
            "term_counts",
            "vocab",
        ),
        "rank_langs_reduce": C.sql(
            f"SELECT c.lang, c.n FROM term_counts c JOIN vocab v ON c.lang = v.lang {rank_order}",
            "term_counts",
            "vocab",
        ),
        "parse_postings": C.sql("SELECT * FROM postings", "postings"),
        "questions": C.sql("SELECT * FROM questions", "questions"),
        "answers": C.sql("SELECT * FROM answers", "answers"),
        "question_answer_join": C.sql("SELECT * FROM qa_pairs", "qa_pairs"),
        "grouped_postings": C.sql(
            "SELECT q_id AS qid, rk // {0} AS chunk, COUNT(*) AS n,"
            " md5(string_agg(a_id || ':' || a_score, ',' ORDER BY rk)) AS pairs_md5 FROM ("
            " SELECT q_id, a_id, a_score, row_number() OVER (PARTITION BY q_id ORDER BY md5(CAST(a_id AS VARCHAR)), a_id, a_score) - 1 AS rk"
            " FROM qa_pairs) GROUP BY q_id, rk // {0}".format(B.PAIR_CHUNK),
            "qa_pairs",
        ),
        "posting_lists": C.sql(
            "SELECT lang, rk // {0} AS chunk, COUNT(*) AS n,"
            " md5(string_agg(title || ':' || length(text), ',' ORDER BY rk)) AS articles_md5 FROM ("
            " SELECT lang, title, text, row_number() OVER (PARTITION BY lang ORDER BY md5(title), title, text) - 1 AS rk"
            " FROM pairs) GROUP BY lang, rk // {0}".format(B.LIST_CHUNK),
            "pairs",
        ),
        "scored_postings": C.sql("SELECT * FROM scored", "scored"),
        "vector_postings": C.sql("SELECT x, y FROM vectors", "vectors"),
        "distinct_vectors": C.sql("SELECT x, y FROM dv", "dv"),
        "sample_per_language": C.sql("SELECT pos, x, y FROM start", "start"),
        "sample_global": C.sql(
            "SELECT CAST(row_number() OVER (ORDER BY h, x, y) - 1 AS INTEGER) AS pos, x, y FROM ("
            f" SELECT x, y, md5(concat_ws('|', {seed}, x, y)) AS h FROM (SELECT DISTINCT x, y FROM vectors_small)"
            f" ORDER BY h, x, y LIMIT {B.CLUSTER_KERNELS})",
            "vectors_small",
        ),
        "point_distance": C.sql(
            f"SELECT d.x, d.y, c.pos, c.x AS cx, c.y AS cy, {_dist('d', 'c')} AS distance"
            " FROM dv d CROSS JOIN start c",
            "dv",
            "start",
        ),
        "nearest_center": C.sql(f"SELECT x, y, cx, cy FROM ({_nearest('dv', 'start')})", "dv", "start"),
        "average_vectors": C.sql(
            "SELECT cx, cy, CAST(SUM(CAST(x AS HUGEINT) * n) // SUM(n) AS INTEGER) AS x,"
            " CAST(SUM(CAST(y AS HUGEINT) * n) // SUM(n) AS INTEGER) AS y, CAST(SUM(n) AS BIGINT) AS n"
            f" FROM ({_nearest('wv', 'start')}) GROUP BY cx, cy",
            "wv",
            "start",
        ),
        "kmeans_step": C.sql("SELECT pos, ox AS old_x, oy AS old_y, nx AS new_x, ny AS new_y FROM m1", "m1"),
        "centers_distance": C.sql("SELECT dist AS distance FROM s1", "s1"),
        "kmeans": C.sql("SELECT pos, x, y FROM final", "final"),
        "kmeans_trace": C.sql("SELECT * FROM trace WHERE (SELECT COUNT(*) FROM final) > 0", "trace", "final"),
        "cluster_results": C.sql(
            "SELECT * FROM clusters ORDER BY median_score, lang, cluster_size", "clusters"
        ),
        "cluster_report": C.sql(
            f"SELECT printf({_q(fmt)}, median_score, lang, lang_percent, cluster_size) AS line FROM clusters"
            " ORDER BY median_score, lang, cluster_size",
            "clusters",
        ),
        "survey_typed": C.sql(f"SELECT tucaseid, {typed_cols} FROM survey", "survey"),
        "classify_columns": C.sql(classify_sql, "survey"),
        "time_usage_summary": C.sql("SELECT * FROM summary", "summary"),
        "time_usage_summary_typed": C.sql("SELECT * FROM summary_typed", "summary_typed"),
        "time_usage_grouped": C.sql(grouped.format(src="summary"), "summary"),
        "time_usage_grouped_sql": C.sql(grouped.format(src="summary"), "summary"),
        "time_usage_grouped_typed": C.sql(grouped.format(src="summary_typed"), "summary_typed"),
        "list_sum": C.sql("SELECT CAST(COALESCE(SUM(x), 0) AS BIGINT) AS list_sum FROM ints", "ints"),
        "list_max": C.sql("SELECT GREATEST(COALESCE(MAX(x), 0), 0) AS list_max FROM ints", "ints"),
    }


ORACLE_SQL: dict[str, str] = _build()
