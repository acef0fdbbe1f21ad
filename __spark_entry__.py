"""

Every query reads the driver's tables through the adapters in
``tessera.sources.testdata`` and runs the library's operators on the whole
tables.  ``oracle_sql()`` re-states each query independently in DuckDB SQL
over the same tables (following the original programs' definitions, e.g. the
join-then-regroup form of the best answer score, and a chain of k-means steps
with the original stopping rule); column names and types match the Spark
output.
"""

from __future__ import annotations

import math
import os
import sys
import uuid
from collections.abc import Callable

# the package sits next to this file; make it importable however this module is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.fixed import DISTANCE_CAP, KMEANS_ETA, KMEANS_MAX_ITERATIONS, SAMPLE_SEED
from tessera.functions.geometry import centres_literal, squared_distance
from tessera.operators import columns, grouped_index, kmeans, postings, ranking, sampling
from tessera.plans.posting_clusters import cluster_postings, vectors_from_postings
from tessera.session import checkpoint_dir, cut_lineage, local_frame
from tessera.sources import testdata as td
from tessera.sources.articles import parse_article_lines
from tessera.sources.postings import parse_posting_lines
from tessera.sources.text import read_lines

SF_SMOKE = "/root/testdata/sf0.001"

DOC_TERMS = td.DOCUMENT_TERMS
TAG_TERMS = td.PRIORITY_TERMS
PARTIAL_TAG_TERMS = td.PRIORITY_TERMS[:2]   # the other tags become -1
K = td.ADAPTER_K
SPREAD = td.ADAPTER_SPREAD
PER_STRATUM = K // len(TAG_TERMS)
OCCURRENCE_TERM = "the"
PAIRS_PER_CHUNK = 3      # small, so that the tables' questions have several groups
ROOT = math.isqrt(PAIRS_PER_CHUNK)
PER_BLOCK = 40           # small, so that frequent terms have several blocks

# the training-data subpackage and its pipeline are optional: without them the
# other queries still work; an import error of anything else is not hidden
try:
    import corpus_pipeline
    from tessera.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("tessera.llm", "corpus_pipeline")):
        raise
    corpus_pipeline = llm_queries = None


# ---------------------------------------------------------------- articles --

def q_rank_terms_combined(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.rank_terms_combined(td.articles(spark, sf), DOC_TERMS)


def q_parse_articles(spark: SparkSession, sf: str) -> DataFrame:
    return parse_article_lines(td.article_lines(td.articles(spark, sf)))


def q_term_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.term_occurrences(td.articles(spark, sf), OCCURRENCE_TERM)


def q_rank_terms(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.rank_terms(td.articles(spark, sf), DOC_TERMS)


def q_inverted_index(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.inverted_index(td.articles(spark, sf), DOC_TERMS)


def q_rank_terms_from_index(spark: SparkSession, sf: str) -> DataFrame:
    index = ranking.inverted_index(td.articles(spark, sf), DOC_TERMS, keep=("title",))
    return ranking.rank_terms_from_index(index, DOC_TERMS)


def q_grouped_index(spark: SparkSession, sf: str) -> DataFrame:
    """The index by term, in bounded blocks; each block's articles written as text."""
    blocks = grouped_index.grouped_index(td.articles(spark, sf), DOC_TERMS, per_block=PER_BLOCK)
    return blocks.selectExpr(
        "term", "block", "n", "array_join(transform(articles, a -> concat_ws(':', a.title, length(a.text), a.copies)), ';') AS articles")


def q_rank_terms_from_grouped_index(spark: SparkSession, sf: str) -> DataFrame:
    blocks = grouped_index.grouped_index(td.articles(spark, sf), DOC_TERMS, keep=("title",), per_block=PER_BLOCK)
    return grouped_index.rank_terms_from_grouped_index(blocks, DOC_TERMS)


def q_read_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of text files: the article dump, written below the checkpoint folder and read again."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    td.article_lines(td.articles(spark, sf)).write.text(folder)
    return read_lines(spark, folder)


# ---------------------------------------------------------------- postings --

def q_parse_postings(spark: SparkSession, sf: str) -> DataFrame:
    return parse_posting_lines(td.posting_lines(td.postings(spark, sf)))


def q_questions(spark: SparkSession, sf: str) -> DataFrame:
    return postings.questions(td.postings(spark, sf))


def q_answers(spark: SparkSession, sf: str) -> DataFrame:
    return postings.answers(td.postings(spark, sf))


def q_question_answer_join(spark: SparkSession, sf: str) -> DataFrame:
    return postings.question_answer_pairs(td.postings(spark, sf))


def q_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    return postings.pair_counts(td.postings(spark, sf))


def q_grouped_postings(spark: SparkSession, sf: str) -> DataFrame:
    """The pairs of every question, a few to a group; each pair written as text."""
    groups = postings.grouped_postings(td.postings(spark, sf), PAIRS_PER_CHUNK)
    side = "concat_ws('|', {0}.id, {0}.score, coalesce({0}.tags, '-'), coalesce({0}.accepted_answer, -1), coalesce({0}.parent_id, -1))"
    pair = f"concat_ws('>', {side.format('p.question')}, {side.format('p.answer')}, p.n)"
    return groups.selectExpr("qid", "chunk", f"array_join(array_sort(transform(pairs, p -> {pair})), ';') AS pairs")


def q_scored_postings(spark: SparkSession, sf: str) -> DataFrame:
    return postings.scored_postings(td.postings(spark, sf))


def q_tag_index(spark: SparkSession, sf: str) -> DataFrame:
    qs = postings.questions(td.postings(spark, sf)).select("id", "tags")
    return postings.tag_index(qs, PARTIAL_TAG_TERMS)


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return vectors_from_postings(td.postings(spark, sf), TAG_TERMS, SPREAD)


def q_vector_postings(spark: SparkSession, sf: str) -> DataFrame:
    return _vectors(spark, sf)


# -------------------------------------------------------------- clustering --

def q_sample_stratified(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_stratified(_vectors(spark, sf), PER_STRATUM).select("cluster", "x", "y")


def q_sample_global(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_global(_vectors(spark, sf), K)


def _sampled(spark: SparkSession, sf: str) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The vectors, computed once, and the initial means drawn from them."""
    vectors = cut_lineage(_vectors(spark, sf))
    return vectors, sampling.initial_means(vectors, K, TAG_TERMS, SPREAD)


def q_assign_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return kmeans.assign_clusters(*_sampled(spark, sf))


def q_squared_distance(spark: SparkSession, sf: str) -> DataFrame:
    vectors, centres = _sampled(spark, sf)
    assigned = kmeans.assign_clusters(vectors, centres)
    c = F.element_at(centres_literal(centres), F.col("cluster") + 1)
    return assigned.select("id", "cluster",
                           squared_distance("x", "y", c["cx"], c["cy"]).alias("distance"))


def q_update_means(spark: SparkSession, sf: str) -> DataFrame:
    vectors, centres = _sampled(spark, sf)
    return kmeans.update_means(kmeans.weighted_points(vectors), centres)


def q_total_shift(spark: SparkSession, sf: str) -> DataFrame:
    vectors, centres = _sampled(spark, sf)
    new = kmeans.update_means(kmeans.weighted_points(vectors), centres).select("cluster", "x", "y")
    old = local_frame(spark, [(i, x, y) for i, (x, y) in enumerate(centres)], "cluster INT, x INT, y INT")
    # a cluster without points keeps its mean
    moved = old.join(new.select("cluster", F.struct("x", "y").alias("m")), "cluster", "left").select(
        "cluster", F.coalesce("m.x", "x").alias("x"), F.coalesce("m.y", "y").alias("y"))
    return kmeans.total_shift_frame(old, moved).select(
        "total_shift", (F.col("total_shift") < F.lit(KMEANS_ETA)).alias("converged"))


def _cluster_job(spark: SparkSession, sf: str):
    return cluster_postings(td.postings(spark, sf), TAG_TERMS, SPREAD, K)


def q_kmeans(spark: SparkSession, sf: str) -> DataFrame:
    return _cluster_job(spark, sf).means_frame(spark)


def q_kmeans_trace(spark: SparkSession, sf: str) -> DataFrame:
    return _cluster_job(spark, sf).trace(spark)


def q_cluster_results(spark: SparkSession, sf: str) -> DataFrame:
    return _cluster_job(spark, sf).results(spark)


def q_cluster_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _cluster_job(spark, sf).report(spark)


# --------------------------------------------- whole jobs from text lines --

def q_rank_terms_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Article job as originally run: dump lines -> parser -> combined ranking."""
    arts = parse_article_lines(td.article_lines(td.articles(spark, sf)))
    return ranking.rank_terms_combined(arts, DOC_TERMS)


def q_cluster_results_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Postings job as originally run: CSV lines -> parser -> ... -> report."""
    posts = parse_posting_lines(td.posting_lines(td.postings(spark, sf)))
    return cluster_postings(posts, TAG_TERMS, SPREAD, K).results(spark)


# ----------------------------------------------------------------- columns --

def q_column_sum(spark: SparkSession, sf: str) -> DataFrame:
    return columns.column_sum(td.postings(spark, sf), "score", "total")


def q_column_max(spark: SparkSession, sf: str) -> DataFrame:
    return columns.column_max(td.postings(spark, sf), "score", "maximum")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: rank terms by the number of articles mentioning them."""
    return q_rank_terms_combined(spark, SF_SMOKE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {
        "rank_terms_combined": q_rank_terms_combined,
        "parse_articles": q_parse_articles,
        "term_occurrences": q_term_occurrences,
        "rank_terms": q_rank_terms,
        "inverted_index": q_inverted_index,
        "rank_terms_from_index": q_rank_terms_from_index,
        "grouped_index": q_grouped_index,
        "rank_terms_from_grouped_index": q_rank_terms_from_grouped_index,
        "read_lines": q_read_lines,
        "parse_postings": q_parse_postings,
        "questions": q_questions,
        "answers": q_answers,
        "question_answer_join": q_question_answer_join,
        "pair_counts": q_pair_counts,
        "grouped_postings": q_grouped_postings,
        "scored_postings": q_scored_postings,
        "tag_index": q_tag_index,
        "vector_postings": q_vector_postings,
        "sample_stratified": q_sample_stratified,
        "sample_global": q_sample_global,
        "assign_clusters": q_assign_clusters,
        "squared_distance": q_squared_distance,
        "update_means": q_update_means,
        "total_shift": q_total_shift,
        "kmeans": q_kmeans,
        "kmeans_trace": q_kmeans_trace,
        "cluster_results": q_cluster_results,
        "cluster_report_lines": q_cluster_report_lines,
        "column_sum": q_column_sum,
        "column_max": q_column_max,
        "rank_terms_from_lines": q_rank_terms_from_lines,
        "cluster_results_from_lines": q_cluster_results_from_lines,
    }
    if llm_queries is not None:
        out |= llm_queries.queries()
        out["pipeline"] = corpus_pipeline.run
    return out


# ================================================================== oracles ==

def _s(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _list(terms) -> str:
    return "[" + ", ".join(_s(t) for t in terms) + "]"


def _terms_cte(terms) -> str:
    rows = ", ".join(f"({i}, {_s(t)})" for i, t in enumerate(terms))
    return f"terms(pos, term) AS (VALUES {rows})"


_ARTICLES = "articles AS (SELECT CAST(doc_id AS VARCHAR) AS title, text FROM documents)"

# (article, term) pairs where the term is one of the article's space tokens
_MENTIONS = """mentions AS (
  SELECT t.pos, t.term, a.title, a.text
  FROM articles a JOIN terms t ON list_contains(string_split(a.text, ' '), t.term))"""

_RANK = "CAST(row_number() OVER (ORDER BY n DESC, pos) AS INTEGER) AS rank"

_POSTINGS = f"""postings AS (
  SELECT CAST(1 AS INTEGER) AS posting_type, CAST(o_orderkey AS BIGINT) AS id,
         CAST(o_orderkey * 8 + 1 AS BIGINT) AS accepted_answer, CAST(NULL AS BIGINT) AS parent_id,
         CAST(floor(o_totalprice / 1000) AS INTEGER) AS score,
         CASE WHEN o_orderpriority <> {_s(td.UNSPECIFIED_PRIORITY)} THEN o_orderpriority END AS tags
  FROM orders
  UNION ALL
  SELECT CAST(2 AS INTEGER), CAST(l_orderkey * 8 + l_linenumber AS BIGINT), CAST(NULL AS BIGINT),
         CAST(l_orderkey AS BIGINT), CAST(floor(l_extendedprice / 100) AS INTEGER),
         CAST(NULL AS VARCHAR)
  FROM lineitem)"""

_POSTING_COLS = ["posting_type", "id", "accepted_answer", "parent_id", "score", "tags"]

# the same two sides straight from their tables
_Q_A = f"""q AS (
  SELECT CAST(1 AS INTEGER) AS posting_type, CAST(o_orderkey AS BIGINT) AS id,
         CAST(o_orderkey * 8 + 1 AS BIGINT) AS accepted_answer, CAST(NULL AS BIGINT) AS parent_id,
         CAST(floor(o_totalprice / 1000) AS INTEGER) AS score,
         CASE WHEN o_orderpriority <> {_s(td.UNSPECIFIED_PRIORITY)} THEN o_orderpriority END AS tags
  FROM orders),
a AS (
  SELECT CAST(2 AS INTEGER) AS posting_type, CAST(l_orderkey * 8 + l_linenumber AS BIGINT) AS id,
         CAST(NULL AS BIGINT) AS accepted_answer, CAST(l_orderkey AS BIGINT) AS parent_id,
         CAST(floor(l_extendedprice / 100) AS INTEGER) AS score, CAST(NULL AS VARCHAR) AS tags
  FROM lineitem)"""

_QA = """q AS (SELECT * FROM postings WHERE posting_type = 1),
a AS (SELECT * FROM postings WHERE posting_type = 2 AND parent_id IS NOT NULL)"""

# best answer score the original way: join every pair, regroup by the full question
_SCORED = f"""{_QA},
scored AS (
  SELECT {', '.join('q.' + c for c in _POSTING_COLS)}, max(a.score) AS high_score
  FROM q JOIN a ON q.id = a.parent_id
  GROUP BY {', '.join('q.' + c for c in _POSTING_COLS)})"""

_VECTORS = f"""{_SCORED},
vectors AS (
  SELECT id,
         CAST(coalesce(CASE WHEN tags IS NULL THEN NULL
                            ELSE coalesce(list_position({_list(TAG_TERMS)}, tags), 0) - 1 END, 0)
              * {SPREAD} AS INTEGER) AS x,
         high_score AS y
  FROM scored)"""

_DRAW = f"md5('{SAMPLE_SEED}:' || CAST(id AS VARCHAR)), id, x, y"

_SAMPLE = f"""{_VECTORS},
ranked AS (SELECT id, x, y, row_number() OVER (PARTITION BY x ORDER BY {_DRAW}) AS rn FROM vectors),
sample AS (SELECT CAST(row_number() OVER (ORDER BY x, rn) - 1 AS INTEGER) AS cluster, x, y
           FROM ranked WHERE rn <= {PER_STRATUM})"""


def _sq(ax: str, ay: str, bx: str, by: str) -> str:
    dx = f"CAST(CAST({ax} AS BIGINT) - CAST({bx} AS BIGINT) AS DOUBLE)"
    dy = f"CAST(CAST({ay} AS BIGINT) - CAST({by} AS BIGINT) AS DOUBLE)"
    return f"({dx} * {dx} + {dy} * {dy})"


def _assign(rows: str, cols: str, means: str, where: str = "") -> str:
    """Nearest mean of every row: lowest index on ties, cap -> cluster 0."""
    return f"""SELECT {cols},
         CAST(coalesce(arg_min(cluster, [d, CAST(cluster AS DOUBLE)])
                       FILTER (WHERE d < {DISTANCE_CAP}), 0) AS INTEGER) AS cluster
  FROM (SELECT {', '.join('r.' + c.strip() for c in cols.split(','))}, m.cluster,
               {_sq('r.x', 'r.y', 'm.mx', 'm.my')} AS d
        FROM {rows} r CROSS JOIN {means} m {where})
  GROUP BY {cols}"""


def _kmeans_chain(max_iter: int = KMEANS_MAX_ITERATIONS, eta: float = KMEANS_ETA) -> str:
    """CTEs m0..m{max_iter} (means after each step) and d0.. (stopped yet?).

    A step runs only while no earlier step converged; afterwards the means
    are carried forward unchanged, so m{max_iter} is the result.
    """
    parts = [
        "points AS MATERIALIZED (SELECT x, y, count(*) AS n FROM vectors GROUP BY x, y)",
        "m0 AS MATERIALIZED (SELECT cluster, CAST(x AS BIGINT) AS mx, CAST(y AS BIGINT) AS my FROM sample)",
        "d0 AS MATERIALIZED (SELECT false AS done)",
    ]
    for i in range(1, max_iter + 1):
        p = i - 1
        parts.append(f"""a{i} AS MATERIALIZED (
  {_assign('points', 'x, y, n', f'm{p}', f'WHERE NOT (SELECT done FROM d{p})')})""")
        parts.append(f"""u{i} AS (SELECT cluster, CAST(sum(x * n) // sum(n) AS BIGINT) AS nx,
              CAST(sum(y * n) // sum(n) AS BIGINT) AS ny FROM a{i} GROUP BY cluster)""")
        parts.append(f"""m{i} AS MATERIALIZED (
  SELECT o.cluster,
         CASE WHEN d.done OR u.cluster IS NULL THEN o.mx ELSE u.nx END AS mx,
         CASE WHEN d.done OR u.cluster IS NULL THEN o.my ELSE u.ny END AS my
  FROM m{p} o CROSS JOIN d{p} d LEFT JOIN u{i} u ON u.cluster = o.cluster)""")
        parts.append(f"""d{i} AS MATERIALIZED (
  SELECT d.done OR coalesce((SELECT sum({_sq('o.mx', 'o.my', 'n.mx', 'n.my')})
                             FROM m{p} o JOIN m{i} n USING (cluster)), 0) < {eta} AS done
  FROM d{p} d)""")
    return ",\n".join(parts)


def _trace_rows(max_iter: int = KMEANS_MAX_ITERATIONS) -> str:
    steps = []
    for i in range(1, max_iter + 1):
        p = i - 1
        steps.append(f"""SELECT CAST({i} AS INTEGER) AS iter, o.cluster,
       CAST(o.mx AS INTEGER) AS old_x, CAST(o.my AS INTEGER) AS old_y,
       CAST(n.mx AS INTEGER) AS new_x, CAST(n.my AS INTEGER) AS new_y,
       {_sq('o.mx', 'o.my', 'n.mx', 'n.my')} AS shift
FROM m{p} o JOIN m{i} n USING (cluster) WHERE NOT (SELECT done FROM d{p})""")
    return "\nUNION ALL\n".join(steps)


_FINAL = f"m{KMEANS_MAX_ITERATIONS}"

_RESULTS = f"""fa AS ({_assign('vectors', 'id, x, y', _FINAL)}),
bylang AS (SELECT cluster, x // {SPREAD} AS lang, count(*) AS cnt FROM fa GROUP BY cluster, x // {SPREAD}),
top AS (SELECT cluster, arg_max(lang, [cnt, -lang]) AS lang, max(cnt) AS cnt, sum(cnt) AS size
        FROM bylang GROUP BY cluster),
ordered AS (SELECT cluster, y, row_number() OVER (PARTITION BY cluster ORDER BY y) - 1 AS i,
                   count(*) OVER (PARTITION BY cluster) AS sz FROM fa),
med AS (SELECT cluster,
               CASE WHEN max(sz) % 2 = 1 THEN max(y) FILTER (WHERE i = sz // 2)
                    ELSE (max(y) FILTER (WHERE i = sz // 2 - 1) + max(y) FILTER (WHERE i = sz // 2)) // 2
               END AS median_score
        FROM ordered GROUP BY cluster),
results AS (
  SELECT CAST(row_number() OVER (ORDER BY median_score, cluster) AS INTEGER) AS rank,
         cluster, list_extract({_list(TAG_TERMS)}, lang + 1) AS label,
         (CAST(cnt AS DOUBLE) / CAST(size AS DOUBLE)) * 100 AS percent,
         CAST(size AS BIGINT) AS size, CAST(median_score AS INTEGER) AS median_score
  FROM top JOIN med USING (cluster))"""


def _posting_lines() -> str:
    fields = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _POSTING_COLS)
    return f"lines AS (SELECT concat_ws(',', {fields}) AS value FROM postings)"


_PARSED_FIELDS = """SELECT CAST(f[1] AS INTEGER) AS posting_type, CAST(f[2] AS BIGINT) AS id,
       CASE WHEN f[3] = '' THEN NULL ELSE CAST(f[3] AS BIGINT) END AS accepted_answer,
       CASE WHEN f[4] = '' THEN NULL ELSE CAST(f[4] AS BIGINT) END AS parent_id,
       CAST(f[5] AS INTEGER) AS score,
       CASE WHEN len(f) >= 6 THEN f[6] END AS tags
FROM fields"""


def oracle_sql() -> dict[str, str]:
    terms = _terms_cte(DOC_TERMS)
    qcols = ", ".join(f"q.{c} AS q_{c}" for c in _POSTING_COLS)
    acols = ", ".join(f"a.{c} AS a_{c}" for c in _POSTING_COLS)
    chain = _kmeans_chain()
    out = {
        "rank_terms_combined": f"""
WITH {terms}, {_ARTICLES}, {_MENTIONS},
counts AS (SELECT pos, term, count(*) AS n FROM mentions GROUP BY pos, term)
SELECT {_RANK}, term, CAST(n AS BIGINT) AS n FROM counts ORDER BY rank""",

        "parse_articles": f"""
WITH lines AS (
  SELECT '{td.ARTICLE_PREFIX}' || CAST(doc_id AS VARCHAR) || '</title><text>' || text
         || '{td.ARTICLE_SUFFIX}' AS value FROM documents),
marked AS (SELECT value, instr(value, '</title><text>') - 1 AS i FROM lines)
SELECT substring(value, 15, i - 14) AS title,
       substring(value, i + 15, length(value) - 16 - (i + 14)) AS text
FROM marked""",

        "term_occurrences": f"""
WITH {_ARTICLES}
SELECT {_s(OCCURRENCE_TERM)} AS term, CAST(count(*) AS BIGINT) AS n
FROM articles WHERE list_contains(string_split(text, ' '), {_s(OCCURRENCE_TERM)})""",

        "rank_terms": f"""
WITH {terms}, {_ARTICLES}, {_MENTIONS},
counts AS (SELECT t.pos, t.term, count(m.title) AS n
           FROM terms t LEFT JOIN mentions m ON m.pos = t.pos GROUP BY t.pos, t.term)
SELECT {_RANK}, term, CAST(n AS BIGINT) AS n FROM counts ORDER BY rank""",

        "inverted_index": f"""
WITH {terms}, {_ARTICLES}, {_MENTIONS}
SELECT term, title, text FROM mentions""",

        "rank_terms_from_index": f"""
WITH {terms}, {_ARTICLES}, {_MENTIONS},
counts AS (SELECT pos, term, count(*) AS n FROM mentions GROUP BY pos, term)
SELECT {_RANK}, term, CAST(n AS BIGINT) AS n FROM counts ORDER BY rank""",

        "grouped_index": f"""
WITH {terms}, {_ARTICLES}, {_MENTIONS},
entries AS (SELECT term, title, text, count(*) AS copies, md5(concat_ws('|', title, text)) AS h FROM mentions GROUP BY term, title, text),
sized AS (SELECT *, sum(copies) OVER (PARTITION BY term) AS c FROM entries),
bucketed AS (SELECT *, CAST(CASE WHEN c <= {PER_BLOCK} THEN 1 ELSE (2 * c + {PER_BLOCK} - 1) // {PER_BLOCK} END AS BIGINT) AS buckets FROM sized),
dealt AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % buckets AS bucket FROM bucketed),
placed AS (SELECT *, bucket + (row_number() OVER (PARTITION BY term, bucket ORDER BY h) - 1) // {PER_BLOCK} * buckets AS block FROM dealt)
SELECT term, CAST(block AS BIGINT) AS block, CAST(sum(copies) AS BIGINT) AS n,
       string_agg(concat_ws(':', title, length(text), copies), ';' ORDER BY h) AS articles
FROM placed GROUP BY term, block""",

        "rank_terms_from_grouped_index": f"""
WITH {terms}, {_ARTICLES}, {_MENTIONS},
counts AS (SELECT pos, term, count(*) AS n FROM mentions GROUP BY pos, term)
SELECT {_RANK}, term, CAST(n AS BIGINT) AS n FROM counts ORDER BY rank""",

        # a text file has a line wherever a text has a line break
        "read_lines": f"""
SELECT unnest(regexp_split_to_array('{td.ARTICLE_PREFIX}' || CAST(doc_id AS VARCHAR) || '</title><text>' || text
  || '{td.ARTICLE_SUFFIX}', '\r\n|\r|\n')) AS value FROM documents""",

        "parse_postings": f"""
WITH {_POSTINGS}, {_posting_lines()},
fields AS (SELECT string_split(rtrim(value, ','), ',') AS f FROM lines)
{_PARSED_FIELDS}""",

        "questions": f"WITH {_POSTINGS} SELECT * FROM postings WHERE posting_type = 1",

        "answers": f"""WITH {_POSTINGS}
SELECT * FROM postings WHERE posting_type = 2 AND parent_id IS NOT NULL""",

        "question_answer_join": f"""WITH {_Q_A}
SELECT q.id AS qid, {qcols}, {acols} FROM q JOIN a ON q.id = a.parent_id""",

        "pair_counts": f"""WITH {_POSTINGS}, {_QA}
SELECT q.id AS qid, count(*) AS n_pairs FROM q JOIN a ON q.id = a.parent_id GROUP BY q.id""",

        # cells of at most PAIRS_PER_CHUNK pairs: the side of fewer rows gives up to the root of it, the other what is left
        "grouped_postings": f"""WITH {_Q_A},
sides AS (SELECT true AS is_q, id AS qid, * FROM q UNION ALL SELECT false, parent_id, * FROM a),
rows AS (
  SELECT is_q, qid, id, concat_ws('|', id, score, coalesce(tags, '-'), coalesce(accepted_answer, -1), coalesce(parent_id, -1)) AS s, count(*) AS n,
         md5(concat_ws(',', {', '.join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _POSTING_COLS)})) AS h
  FROM sides GROUP BY ALL),
sized AS (
  SELECT *, count(*) FILTER (WHERE is_q) OVER (PARTITION BY qid) AS nq, count(*) FILTER (WHERE NOT is_q) OVER (PARTITION BY qid) AS na FROM rows),
bounds AS (
  SELECT *, CASE WHEN nq <= na THEN least(nq, {ROOT}) ELSE {PAIRS_PER_CHUNK} // least(na, {ROOT}) END AS q,
    CASE WHEN nq <= na THEN {PAIRS_PER_CHUNK} // least(nq, {ROOT}) ELSE least(na, {ROOT}) END AS a
  FROM sized WHERE nq > 0 AND na > 0),
side AS (SELECT *, CASE WHEN is_q THEN nq ELSE na END AS total, CASE WHEN is_q THEN q ELSE a END AS size FROM bounds),
bucketed AS (
  SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % CASE WHEN total <= size THEN 1 ELSE (2 * total + size - 1) // size END AS bucket,
    CASE WHEN total <= size THEN 1 ELSE (2 * total + size - 1) // size END AS buckets FROM side),
cells AS (SELECT *, bucket + (row_number() OVER (PARTITION BY qid, is_q, bucket ORDER BY h) - 1) // size * buckets AS cell FROM bucketed)
SELECT x.qid, CAST(x.cell * 2147483648 + y.cell AS BIGINT) AS chunk,
  string_agg(concat_ws('>', x.s, y.s, x.n * y.n), ';' ORDER BY concat_ws('>', x.s, y.s, x.n * y.n)) AS pairs
FROM cells x JOIN cells y ON x.qid = y.qid AND x.is_q AND NOT y.is_q GROUP BY 1, 2""",

        "scored_postings": f"WITH {_POSTINGS}, {_SCORED} SELECT * FROM scored",

        "tag_index": f"""WITH {_POSTINGS}
SELECT id, tags,
       CASE WHEN tags IS NULL THEN NULL
            ELSE CAST(coalesce(list_position({_list(PARTIAL_TAG_TERMS)}, tags), 0) - 1 AS INTEGER)
       END AS lang_index
FROM postings WHERE posting_type = 1""",

        "vector_postings": f"WITH {_POSTINGS}, {_VECTORS} SELECT id, x, y FROM vectors",

        "sample_stratified": f"WITH {_POSTINGS}, {_SAMPLE} SELECT cluster, x, y FROM sample",

        "sample_global": f"""WITH {_POSTINGS}, {_VECTORS}
SELECT CAST(row_number() OVER (ORDER BY {_DRAW}) - 1 AS INTEGER) AS cluster, x, y
FROM vectors ORDER BY {_DRAW} LIMIT {K}""",

        "assign_clusters": f"""WITH {_POSTINGS}, {_SAMPLE},
m AS (SELECT cluster, x AS mx, y AS my FROM sample)
{_assign('vectors', 'id, x, y', 'm')}""",

        "squared_distance": f"""WITH {_POSTINGS}, {_SAMPLE},
m AS (SELECT cluster, x AS mx, y AS my FROM sample),
asg AS ({_assign('vectors', 'id, x, y', 'm')})
SELECT asg.id, asg.cluster, {_sq('asg.x', 'asg.y', 'm.mx', 'm.my')} AS distance
FROM asg JOIN m USING (cluster)""",

        "update_means": f"""WITH {_POSTINGS}, {_SAMPLE},
m AS (SELECT cluster, x AS mx, y AS my FROM sample),
asg AS ({_assign('vectors', 'id, x, y', 'm')})
SELECT cluster, CAST(sum(CAST(x AS BIGINT)) // count(*) AS INTEGER) AS x,
       CAST(sum(CAST(y AS BIGINT)) // count(*) AS INTEGER) AS y, CAST(count(*) AS BIGINT) AS size
FROM asg GROUP BY cluster""",

        "total_shift": f"""WITH {_POSTINGS}, {_SAMPLE},
m AS (SELECT cluster, x AS mx, y AS my FROM sample),
asg AS ({_assign('vectors', 'id, x, y', 'm')}),
upd AS (SELECT cluster, sum(CAST(x AS BIGINT)) // count(*) AS nx,
               sum(CAST(y AS BIGINT)) // count(*) AS ny FROM asg GROUP BY cluster),
s AS (SELECT sum({_sq('m.mx', 'm.my', 'upd.nx', 'upd.ny')}) AS total_shift
      FROM m JOIN upd USING (cluster))
SELECT total_shift, total_shift < {KMEANS_ETA} AS converged FROM s""",

        "kmeans": f"""WITH {_POSTINGS}, {_SAMPLE},
{chain}
SELECT cluster, CAST(mx AS INTEGER) AS x, CAST(my AS INTEGER) AS y FROM {_FINAL}""",

        "kmeans_trace": f"""WITH {_POSTINGS}, {_SAMPLE},
{chain}
{_trace_rows()}""",

        "cluster_results": f"""WITH {_POSTINGS}, {_SAMPLE},
{chain},
{_RESULTS}
SELECT * FROM results""",

        "cluster_report_lines": f"""WITH {_POSTINGS}, {_SAMPLE},
{chain},
{_RESULTS}
SELECT rank,
       printf('%7d  %-17s (%-5.1f%%)      %7d', median_score, label,
              -- like java.util.Formatter: shortest decimal form, then half-up
              round(CAST(CAST(percent AS VARCHAR) AS DECIMAL(38, 10)), 1), size) AS line
FROM results""",

        "column_sum": f"""WITH {_POSTINGS}
SELECT CAST(coalesce(sum(CAST(score AS BIGINT)), 0) AS BIGINT) AS total FROM postings""",

        "column_max": f"WITH {_POSTINGS} SELECT max(score) AS maximum FROM postings",
    }
    # the whole jobs from lines: SQL writes the lines and parses them again
    articles_from_lines = f"""
lines AS (
  SELECT '{td.ARTICLE_PREFIX}' || CAST(doc_id AS VARCHAR) || '</title><text>' || text
         || '{td.ARTICLE_SUFFIX}' AS value FROM documents),
marked AS (SELECT value, instr(value, '</title><text>') - 1 AS i FROM lines),
articles AS (
  SELECT substring(value, 15, i - 14) AS title,
         substring(value, i + 15, length(value) - 16 - (i + 14)) AS text FROM marked)"""
    out["rank_terms_from_lines"] = f"""
WITH {terms}, {articles_from_lines}, {_MENTIONS},
counts AS (SELECT pos, term, count(*) AS n FROM mentions GROUP BY pos, term)
SELECT {_RANK}, term, CAST(n AS BIGINT) AS n FROM counts ORDER BY rank"""
    table_postings = _POSTINGS.replace("postings AS (", "table_postings AS (", 1)
    lines = _posting_lines().replace("FROM postings", "FROM table_postings")
    out["cluster_results_from_lines"] = f"""WITH {table_postings}, {lines},
fields AS (SELECT string_split(rtrim(value, ','), ',') AS f FROM lines),
postings AS ({_PARSED_FIELDS}),
{_SAMPLE},
{chain},
{_RESULTS}
SELECT * FROM results"""
    if llm_queries is not None:
        out |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
