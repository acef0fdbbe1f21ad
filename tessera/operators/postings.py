"""Question/answer postings: split, join, best answer score, 2-D vectors.

Scale notes.  The best answer score per question is aggregated before questions
and answers meet (``max`` combines map-side, so a question with a third of all
answers shuffles one partial row per partition), and questions are de-duplicated
on their full row (also map-side combined, so mass copies of one question
collapse early).  One row per distinct question and one per answered parent then
meet by id, instead of every (question, answer) pair.  Where the pairs themselves
are wanted, heavy ids, found by a sketch of the most frequent ids, are dealt into
a grid of questions and answers; no join relies on skew handling at run time.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.fixed import LANG_SPREAD, LANGS
from tessera.functions.text import INLINE_TERMS_MAX, check_terms, term_index, terms_array
from tessera.sources.postings import POSTING_COLUMNS


def questions(postings: DataFrame) -> DataFrame:
    """Postings of type 1 (questions); their key is ``id``."""
    return postings.where(F.col("posting_type") == 1)


def answers(postings: DataFrame) -> DataFrame:
    """Postings of type 2 that have a parent; their key is ``parent_id``."""
    return postings.where((F.col("posting_type") == 2) & F.col("parent_id").isNotNull())


# Ids that the sketch reports, at most; an id beyond them has a smaller share of the rows.
HEAVY_KEYS = 256
SKETCH_ITEMS = 8192
# Postings of one id from which it is dealt apart, and of such an id in one cell, about.
HEAVY_ROWS = 100_000
# Equal postings that travel as one row with a count, at most.
COPIES = 10_000


def _key(question: str = "id", answer: str = "parent_id") -> str:
    """SQL of the id a posting is joined by; null for postings of neither kind."""
    return f"CASE WHEN posting_type = 1 THEN {question} WHEN posting_type = 2 THEN {answer} END"


def heavy_ids(rows: DataFrame, heavy_rows: int = HEAVY_ROWS, key: str | None = None) -> DataFrame:
    """``(heavy_id, n)``: ids with about ``heavy_rows`` questions and answers or more.

    ``key`` is SQL for the id of a row (null: none), by default that of a
    posting.  One pass keeps a sketch of the most frequent ids in each task and
    merges them: at most ``HEAVY_KEYS`` rows whatever the input, with estimated
    counts.  An id it misses has too small a share of all rows to matter.
    """
    keys = rows.selectExpr(f"{key or _key()} AS k").where("k IS NOT NULL")
    top = keys.agg(F.expr(f"approx_top_k(k, {HEAVY_KEYS}, {SKETCH_ITEMS})").alias("top"))
    return top.select(F.explode("top").alias("t")).selectExpr("t.item AS heavy_id", "t.count AS n").where(
        F.col("n") >= F.lit(int(heavy_rows)))


def _salts(rows: DataFrame, heavy_rows: int, key: str) -> DataFrame:
    """``(heavy_id, _salts)``, broadcast: into how many parts the rows of a heavy id are dealt."""
    found = heavy_ids(rows, heavy_rows, key).selectExpr("heavy_id", f"(n + {int(heavy_rows) - 1}) div {int(heavy_rows)} AS _salts")
    return F.broadcast(found)       # HEAVY_KEYS rows at most


def _salted(rows: DataFrame, key: str, salts: DataFrame, spread: str) -> DataFrame:
    """``rows`` with ``_salt``: part ``spread`` of a heavy id's, 0 of any other's.

    ``spread`` is SQL for an array of the parts a row goes to, given ``_salts``.
    """
    joined = rows.join(salts, F.col(key) == F.col("heavy_id"), "left")
    return joined.withColumn("_salt", F.explode(F.expr(f"IF(_salts IS NULL, array(0L), {spread})"))).drop("heavy_id", "_salts")


ALL_SALTS = "sequence(0L, _salts - 1)"
ONE_SALT = f"array(pmod(xxhash64({', '.join(POSTING_COLUMNS)}), _salts))"


def _counted(rows: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct rows with counts, at most ``COPIES`` to a row (``part`` tells them apart)."""
    n = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    parts = n.select(*columns, "_n", F.explode(F.expr(f"sequence(0L, (_n - 1) div {COPIES})")).alias("_part"))
    return parts.selectExpr(*columns, "_part", f"least(_n - _part * {COPIES}, {COPIES}) AS {name}")


def question_answer_pairs(postings: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Inner equi-join of questions (by id) and answers (by parent id).

    One row per (question, answer) pair: ``qid``, the question's columns as
    ``q_*`` and the answer's as ``a_*``.  Unanswered questions and orphan
    answers drop out; duplicated rows on either side multiply.

    Ids that :func:`heavy_ids` reports are joined on their own: their equal rows
    are counted first, then questions and answers are dealt by a hash of the row
    into the sides of a grid with about ``heavy_rows`` rows a cell, and each side
    is sent to the cells of its row or column.  All other ids are joined as they
    are.  Both together are every pair once.
    """
    if heavy_rows < 1:
        raise ValueError("heavy_rows must be >= 1")
    q_cols, a_cols = [f"q_{c}" for c in POSTING_COLUMNS], [f"a_{c}" for c in POSTING_COLUMNS]
    q = questions(postings).selectExpr(*[f"{c} AS q_{c}" for c in POSTING_COLUMNS])
    a = answers(postings).selectExpr(*[f"{c} AS a_{c}" for c in POSTING_COLUMNS])
    heavy = F.broadcast(heavy_ids(postings, heavy_rows).select("heavy_id"))     # HEAVY_KEYS rows at most
    out = ["qid", *q_cols, *a_cols]

    def side(rows: DataFrame, key: str, how: str) -> DataFrame:
        return rows.join(heavy, F.col(key) == F.col("heavy_id"), how)

    light = side(q, "q_id", "left_anti").join(side(a, "a_parent_id", "left_anti"), F.col("q_id") == F.col("a_parent_id"))
    hq = _counted(side(q, "q_id", "left_semi"), q_cols, "_nq")
    ha = _counted(side(a, "a_parent_id", "left_semi"), a_cols, "_na")
    cells = f"(count(1) + {int(heavy_rows) - 1}) div {int(heavy_rows)}"
    grid = hq.groupBy(F.col("q_id").alias("_id")).agg(F.expr(cells).alias("_rows")).join(
        ha.groupBy(F.col("a_parent_id").alias("_aid")).agg(F.expr(cells).alias("_cols")), F.col("_id") == F.col("_aid")).drop("_aid")
    grid = F.broadcast(grid)                                                    # HEAVY_KEYS rows at most
    dealt_q = hq.join(grid, F.col("q_id") == F.col("_id")).withColumns({
        "_r": F.expr(f"pmod(xxhash64({', '.join(q_cols)}, _part), _rows)"), "_c": F.explode(F.expr("sequence(0L, _cols - 1)"))})
    dealt_a = ha.join(grid, F.col("a_parent_id") == F.col("_id")).withColumns({
        "_ac": F.expr(f"pmod(xxhash64({', '.join(a_cols)}, _part), _cols)"), "_ar": F.explode(F.expr("sequence(0L, _rows - 1)"))})
    met = dealt_q.select(*q_cols, "_nq", "_r", "_c").join(
        dealt_a.select(*a_cols, "_na", "_ar", "_ac"),
        (F.col("q_id") == F.col("a_parent_id")) & (F.col("_r") == F.col("_ar")) & (F.col("_c") == F.col("_ac")))
    each = met.withColumn("_i", F.explode(F.expr("sequence(1L, _nq)"))).withColumn("_j", F.explode(F.expr("sequence(1L, _na)")))
    return light.selectExpr("q_id AS qid", *out[1:]).unionByName(each.selectExpr("q_id AS qid", *out[1:]))


# Pairs of one group row; a heavily answered question gets several.
PAIRS_PER_CHUNK = 1000


def pair_counts(postings: DataFrame) -> DataFrame:
    """Pairs per question id: ``(qid, n_pairs)``.

    The number of pairs of an id is (#question rows with that id) x (#answers
    with that parent), so both sides are counted map-side first and the join
    sees one row per id — a question with a third of all answers costs one
    partial row per partition.
    """
    q = questions(postings).groupBy(F.col("id").alias("qid")).agg(F.count(F.lit(1)).alias("_nq"))
    a = (answers(postings).groupBy(F.col("parent_id").alias("_aid"))
         .agg(F.count(F.lit(1)).alias("_na")))
    return q.join(a, F.col("qid") == F.col("_aid"), "inner").select(
        "qid", (F.col("_nq") * F.col("_na")).alias("n_pairs"))


def _cell_sizes(bound: int) -> tuple[str, str]:
    """SQL of how many distinct questions and answers a chunk takes, from their numbers ``_nq`` and ``_na``.

    Their product is at most ``bound``: the side of fewer rows takes up to the
    square root, the other one what is left.
    """
    root = math.isqrt(bound)
    few_q, few_a = f"least(_nq, {root}L)", f"least(_na, {root}L)"
    return (f"IF(_nq <= _na, {few_q}, {bound}L div {few_a})", f"IF(_nq <= _na, {bound}L div {few_q}, {few_a})")


# Slices of one id's larger side that meet the other side in one task, about.
SLICES_PER_TASK = 1000


def grouped_postings(postings: DataFrame, pairs_per_chunk: int = PAIRS_PER_CHUNK, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """The pairs of every question id, in bounded groups: ``(qid, chunk, pairs)``.

    ``pairs`` is an array of ``struct(question, answer, n)``, both full postings
    and how often that pair occurs, ordered; it never has more than
    ``pairs_per_chunk`` entries.  Every distinct pair is in one chunk; an id with
    at most that many has chunk 0 only, chunks of others have numbers with gaps.

    Equal questions and equal answers are counted before they meet.  The distinct
    ones of an id are dealt, each side on its own, by a hash into buckets and
    these into slices, the sides of a grid; a chunk is one cell of it.  What
    meets by id are slices: the larger side's dealt over several tasks, the
    smaller side's sent to each, so the pairs themselves are never shuffled.
    Rows of the ids that :func:`heavy_ids` reports are salted before.
    """
    if pairs_per_chunk < 1 or heavy_rows < 1:
        raise ValueError("pairs_per_chunk and heavy_rows must be >= 1")
    bound = int(pairs_per_chunk)
    rows = postings.selectExpr(f"{_key()} AS qid", *POSTING_COLUMNS).where("qid IS NOT NULL")
    # every use below needs the counts as well, so that one shuffle serves them all
    distinct = rows.groupBy("qid", *POSTING_COLUMNS).agg(F.count(F.lit(1)).alias("_n"))
    sizes = distinct.groupBy(F.col("qid").alias("_qid")).agg(
        F.expr("count_if(posting_type = 1 AND _n > 0)").alias("_nq"), F.expr("count_if(posting_type = 2 AND _n > 0)").alias("_na"))
    q_size, a_size = _cell_sizes(bound)
    # a side that fits into one slice is not dealt; else there are twice as many buckets as slices are needed
    sizes = (sizes.where("_nq > 0 AND _na > 0")
             .selectExpr("_qid", "_nq", "_na", f"{q_size} AS _q", f"{a_size} AS _a")
             .selectExpr("_qid", "_q", "_a", "IF(_nq <= _q, 1L, (2 * _nq + _q - 1) div _q) AS _qb",
                         "IF(_na <= _a, 1L, (2 * _na + _a - 1) div _a) AS _ab")
             .selectExpr("*", "_qb > _ab AS _by_q", f"1 + greatest(_qb, _ab) div {SLICES_PER_TASK} AS _tasks"))
    salts = _salts(distinct, heavy_rows, "IF(_n > 0, qid, NULL)")
    left = _salted(distinct, "qid", salts, ONE_SALT)
    right = _salted(sizes, "_qid", salts, ALL_SALTS).withColumnRenamed("_salt", "_size_salt")
    is_q = "posting_type = 1"
    text = ", ".join(f"coalesce(CAST({c} AS STRING), '')" for c in POSTING_COLUMNS)
    posting = "named_struct(" + ", ".join(f"'{c}', {c}" for c in POSTING_COLUMNS) + ")"
    group = ["qid", "_by_q", "_tasks", "_size", "_buckets", "_bucket"]
    dealt = (left.join(right, (F.col("qid") == F.col("_qid")) & (F.col("_salt") == F.col("_size_salt")))
             .selectExpr("qid", f"{is_q} AS _q_row", "_by_q", "_tasks", f"IF({is_q}, _q, _a) AS _size", f"IF({is_q}, _qb, _ab) AS _buckets",
                         f"IF(IF({is_q}, _qb, _ab) = 1, NULL, md5(CAST(concat_ws(',', {text}) AS BINARY))) AS _order", f"{posting} AS posting", "_n")
             .selectExpr(*group[:-1], "_q_row", "IF(_buckets = 1, 0L, pmod(CAST(conv(substr(_order, 1, 8), 16, 10) AS BIGINT), _buckets)) AS _bucket",
                         "struct(_order, posting, _n AS n) AS entry"))
    # which side a list is of is a result, not only a key: both sides then come from the same shuffle
    lists = dealt.groupBy(*group, "_q_row").agg(F.collect_list("entry").alias("_list"), F.bool_and("_q_row").alias("_is_q"))
    # only a list that is sliced needs an order
    lists = lists.withColumn("_list", F.expr("IF(size(_list) > _size, array_sort(_list), _list)"))
    slices = lists.withColumn("_slice", F.explode(F.expr("sequence(0L, (size(_list) - 1) div _size)"))).selectExpr(
        "qid", "_is_q", "_by_q", "_tasks", "_bucket + _slice * _buckets AS _cell",
        "slice(_list, CAST(_slice * _size AS INT) + 1, CAST(_size AS INT)) AS _list")
    # the side with more slices is dealt over the id's tasks, the other one goes to all of them
    task = "explode(IF(_is_q = _by_q, array(pmod(xxhash64(_cell), _tasks)), sequence(0L, _tasks - 1)))"
    qs = slices.where("_is_q").selectExpr("qid", "_cell AS _r", "_list AS _ql", f"{task} AS _task")
    an = slices.where("NOT _is_q").selectExpr("qid AS _aid", "_cell AS _c", "_list AS _al", f"{task} AS _atask")
    pairs = "flatten(transform(_ql, q -> transform(_al, a -> named_struct('question', q.posting, 'answer', a.posting, 'n', q.n * a.n))))"
    # both numbers of a cell in one: an id has fewer than 2 ** 31 slices of answers
    return qs.join(an, (F.col("qid") == F.col("_aid")) & (F.col("_task") == F.col("_atask"))).selectExpr(
        "qid", "shiftleft(_r, 31) + _c AS chunk", f"array_sort({pairs}) AS pairs")


def best_answer_scores(postings: DataFrame) -> DataFrame:
    """``(parent_id, high_score)``: the maximum answer score per parent id."""
    return answers(postings).groupBy("parent_id").agg(F.max("score").alias("high_score"))


def scored_postings(postings: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Each distinct answered question with its best answer score.

    Output: the six question columns plus ``high_score``.  Identical
    duplicate questions count once; questions sharing an id but differing in
    any field stay apart (all of them get that id's best answer score).

    A map-side combined aggregation leaves one row per distinct question and one
    per answered parent, and a maximum over the rows of an id joins the two.  The
    distinct questions of an id that :func:`heavy_ids` reports are salted by a
    hash of the row, about ``heavy_rows`` to a salt, and the parent's row is sent
    to each salt.
    """
    if heavy_rows < 1:
        raise ValueError("heavy_rows must be >= 1")
    is_q = "posting_type = 1"
    # answers keep only their parent; questions keep all their fields
    keyed = postings.where(f"{is_q} OR (posting_type = 2 AND parent_id IS NOT NULL)").selectExpr(
        f"{is_q} AS is_q", f"CASE WHEN {is_q} THEN id ELSE parent_id END AS qid",
        *[f"CASE WHEN {is_q} THEN {c} END AS {c}" for c in POSTING_COLUMNS],
        f"CASE WHEN NOT ({is_q}) THEN score END AS answer_score")
    collapsed = keyed.groupBy("is_q", "qid", *POSTING_COLUMNS).agg(F.max("answer_score").alias("best"))
    # the sketch needs the scores as well, so that it reads the same shuffle
    salts = _salts(collapsed, heavy_rows, "IF(is_q OR best IS NOT NULL, qid, NULL)")
    salted = _salted(collapsed, "qid", salts, f"IF(is_q, {ONE_SALT}, {ALL_SALTS})")
    of_id = Window.partitionBy("qid", "_salt")
    return (salted.withColumn("high_score", F.max("best").over(of_id))
            .where("is_q AND high_score IS NOT NULL").select(*POSTING_COLUMNS, "high_score"))


def tag_index(scored: DataFrame, terms: Sequence[str] = LANGS, tags: str = "tags") -> DataFrame:
    """Adds ``lang_index``: position of the whole tag in ``terms`` (NULL tag ->
    NULL, unknown tag -> -1)."""
    terms = check_terms(terms)
    if len(terms) <= INLINE_TERMS_MAX:
        return scored.withColumn("lang_index", term_index(tags, terms))
    table = scored.sparkSession.range(1).select(
        F.posexplode(terms_array(terms)).alias("_pos", "_term"))
    joined = scored.join(table, F.col(tags) == F.col("_term"), "left")
    return joined.withColumn(
        "lang_index", F.when(F.col(tags).isNull(), F.lit(None).cast("int"))
                       .otherwise(F.coalesce(F.col("_pos").cast("int"), F.lit(-1)))
    ).drop("_pos", "_term")


def vector_postings(scored: DataFrame, terms: Sequence[str] = LANGS,
                    spread: int = LANG_SPREAD, unknown: str = "keep") -> DataFrame:
    """``(id, x, y)`` per scored question.

    x = (tag position, 0 for a missing tag) * spread — an unknown tag gives
    -spread; y = best answer score.  ``unknown='drop'`` removes unknown-tag
    rows instead of keeping them at -spread.  ``id`` is kept for sampling.
    """
    if spread <= 0:
        raise ValueError("spread must be positive to recover the term from x")
    if unknown not in ("keep", "drop"):
        raise ValueError("unknown must be 'keep' or 'drop'")
    if (len(check_terms(terms)) - 1) * spread > 2**31 - 1:
        raise ValueError("term index x spread does not fit the INT x coordinate")
    idx = F.col("lang_index")
    out = tag_index(scored, terms).select(
        "id", (F.coalesce(idx, F.lit(0)) * F.lit(spread)).cast("int").alias("x"),
        F.col("high_score").cast("int").alias("y"))
    if unknown == "drop":
        out = out.where(F.col("x") >= 0)
    return out
