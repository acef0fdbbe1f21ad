"""tessera — batch text-ranking and Q&A clustering on Spark DataFrames.

Three families of operators, each a function ``DataFrame (+ params) -> DataFrame``
built from ``pyspark.sql.functions`` only (an optional subpackage for training
data is described in the README):

* article term ranking (``tessera.operators.ranking``),
* question/answer posting scoring (``tessera.operators.postings``),
* integer k-means over 2-D vectors with a cluster report
  (``tessera.operators.sampling``, ``.kmeans``, ``.selection``, ``.report``),

plus two column aggregates (``tessera.operators.columns``).  Sources live in
``tessera.sources``, column expressions in ``tessera.functions``, the two
end-to-end jobs (also runnable as ``python -m tessera.plans.article_ranking``
and ``python -m tessera.plans.posting_clusters``) in ``tessera.plans``, and the
incremental (Structured Streaming) form of the ranking in ``tessera.streaming``.
"""

__version__ = "0.1.0"
