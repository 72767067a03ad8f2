"""Constants that are part of the public API.

Everything under the "fixed values" heading must stay equal to the values
of the programs whose results this library reproduces: changing one of them
changes results (vector coordinates, column classes, report layout).
Everything else is a tunable default.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (must equal the original programs' values for equal results)
# ---------------------------------------------------------------------------

# Programming-language vocabulary; a term's position is its vector index.
LANGUAGES: tuple[str, ...] = (
    "JavaScript", "Java", "PHP", "Python", "C#", "C++", "Ruby", "CSS",
    "Objective-C", "Perl", "Scala", "Haskell", "MATLAB", "Clojure", "Groovy",
)

# k-means settings.
LANG_SPREAD = 50000
KMEANS_KERNELS = 45
KMEANS_ETA = 20.0
KMEANS_MAX_ITERATIONS = 120
# Below this spread, starting centres are drawn from the whole space.
SMALL_SPREAD_THRESHOLD = 500
SAMPLE_SEED = 42

# Article line layout: title starts at this 0-based offset, the text ends
# this many characters before the end of the line.
ARTICLE_SEPARATOR = "</title><text>"
ARTICLE_TITLE_OFFSET = 14
ARTICLE_TAIL = 16

# Time-use column classes, by column-name prefix; first matching class wins.
PRIMARY_NEEDS_PREFIXES: tuple[str, ...] = ("t01", "t03", "t11", "t1801", "t1803")
WORK_PREFIXES: tuple[str, ...] = ("t05", "t1805")
OTHER_PREFIXES: tuple[str, ...] = (
    "t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14",
    "t15", "t16", "t18",
)

# Labour-force and demographic bands.
WORKING_TELFS_RANGE = (1, 3)  # 1 <= telfs < 3 is "working"
LABOUR_FORCE_MAX_TELFS = 4  # rows with telfs <= 4 are kept
YOUNG_AGES = (15, 22)
ACTIVE_AGES = (23, 55)

# One line of the cluster report: median score, dominant language, percent, size.
CLUSTER_REPORT_FORMAT = "%7d  %-17s (%-5.1f%%)      %7d"

# ---------------------------------------------------------------------------
# Tunable defaults (not fixed by the original programs)
# ---------------------------------------------------------------------------

