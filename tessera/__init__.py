"""tessera: text ranking, Q&A clustering, time-use summaries and list aggregates on Spark DataFrames.

Subpackages:

* ``sources``   - text lines, article and posting parsers, survey CSV;
* ``functions`` - column expressions (tokens, distances, survey bands, strict casts);
* ``operators`` - DataFrame operators (rankings, postings, sampling, k-means, reports, survey, aggregates);
* ``plans``     - bindings of the supplied tables, the query catalog and its SQL oracle;
* ``streaming`` - empty: the original programs have no streaming part.
"""

__version__ = "0.1.0"
