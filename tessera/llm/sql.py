"""DuckDB SQL for the queries of this subpackage that SQL can express."""

MIXTURE = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0b\f\r]+')) AS BIGINT) AS size
  FROM documents),
totals AS (SELECT source, sum(size) AS s FROM sized GROUP BY source),
turns AS (
  SELECT source, s, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM totals),
levels AS (SELECT *, CAST(3 * s AS DOUBLE) / w AS level FROM turns),
run AS (
  SELECT *,
    CAST((SELECT sum(s) FROM totals) - coalesce(sum(3 * s) OVER before, 0) AS DOUBLE)
      / CAST((SELECT sum(w) FROM turns) - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS shared
  FROM levels
  WINDOW before AS (ORDER BY level, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
water AS (SELECT shared FROM run WHERE shared <= level ORDER BY level, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, s, coalesce(least(w * (SELECT shared FROM water), CAST(3 * s AS DOUBLE)), 0) AS target FROM run),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5(CAST(doc_id AS VARCHAR)) NULLS LAST, doc_id NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at
  FROM sized)
SELECT p.doc_id, p.size, CAST(t.s AS BIGINT) AS source_size, CAST(t.target AS DOUBLE) AS target,
  CAST(greatest(0, least(p.size, floor(t.target) - p.at))
     + greatest(0, least(p.size, floor(t.target) - p.at - t.s))
     + greatest(0, least(p.size, floor(t.target) - p.at - 2 * t.s)) AS BIGINT) AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
"""

TOP_K = """
WITH rows AS (
  SELECT row_number() OVER () AS key, vec_id AS id, [CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT) for x in embedding] AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (SELECT key, id, unnest(range(1, len(w) + 1)) AS term, unnest(w) AS x FROM rows),
dots AS (
  SELECT q.key AS query, c.key AS key, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts q JOIN parts c ON q.term = c.term AND q.key <> c.key WHERE q.id % 100 = 0 GROUP BY q.key, c.key),
-- vectors without a common term have the score 0
ranked AS (
  SELECT q.id AS query_id, c.id AS vec_id, coalesce(d.score, 0) AS score,
    CAST(row_number() OVER (PARTITION BY q.key ORDER BY coalesce(d.score, 0) DESC, c.id, c.key) AS INTEGER) AS rank
  FROM rows q JOIN rows c ON q.key <> c.key LEFT JOIN dots d ON d.query = q.key AND d.key = c.key WHERE q.id % 100 = 0)
SELECT query_id, rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""

HARD_NEGATIVES = """
WITH rows AS (
  SELECT row_number() OVER () AS key, vec_id AS id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    [CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT) for x in embedding] AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
parts AS (SELECT key, id, label, unnest(range(1, len(w) + 1)) AS term, unnest(w) AS x FROM rows),
dots AS (
  SELECT a.key AS anchor, c.key AS key, CAST(sum(a.x * c.x) AS BIGINT) AS score
  FROM parts a JOIN parts c ON a.term = c.term AND a.key <> c.key WHERE a.id % 50 = 0 GROUP BY a.key, c.key),
-- vectors without a common term have the score 0
scores AS (
  SELECT a.key AS anchor, a.id AS anchor_id, c.key, c.id, a.label = c.label AS same, coalesce(d.score, 0) AS score
  FROM rows a JOIN rows c ON a.key <> c.key LEFT JOIN dots d ON d.anchor = a.key AND d.key = c.key WHERE a.id % 50 = 0),
positives AS (
  SELECT anchor, anchor_id, key AS positive, id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, key) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, n.id AS negative_id, p.positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY n.score DESC, n.id, n.key) AS INTEGER) AS rank
  FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
    AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""


def _merkle(levels: int = 7, top_levels: int = 4) -> str:
    """Trees of up to 8 ** levels leaves under up to 8 ** top_levels groups."""
    def field(c: str) -> str:
        return f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"

    def digest(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        "docs AS (SELECT row_number() OVER () AS rid, * FROM documents)",
        # crc32 of the id's digits, bit by bit
        """crc AS (
  SELECT rid, CAST(doc_id AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM docs WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT rid, s, k + 1,
    xor(c >> 1, CASE WHEN (xor(c, ascii(substr(s, k // 8 + 1, 1)) >> (k % 8)) & 1) = 1 THEN CAST(3988292384 AS BIGINT) ELSE 0 END)
  FROM crc WHERE k < 8 * len(s))""",
        "sums AS (SELECT rid, xor(c, CAST(4294967295 AS BIGINT)) % 3 = 0 AS changed FROM crc WHERE k = 8 * len(s))",
        f"hashed AS (SELECT rid, doc_id, lang, {digest('text')} AS leaf, {digest(lower)} AS lowered FROM docs)",
        """placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
  FROM hashed)""",
        "l0 AS (SELECT lang, i, leaf AS d, n FROM placed)",
    ]

    def chain(name: str, runs: str, steps: int) -> None:
        for k in range(steps):
            parts.append(f"""{name}{k + 1} AS (
  SELECT lang, i // 8 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d, (n + 7) // 8 AS n FROM {name}{k} WHERE n > 1 GROUP BY lang, i // 8, n)""")
            parts.append(f"""{runs}{k} AS (
  SELECT lang, i,
    coalesce(string_agg(d, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(d, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k} WHERE n > 1 WINDOW run AS (PARTITION BY lang, i // 8 ORDER BY i))""")

    def climb(name: str, runs: str, steps: int, index: str) -> None:
        for k in range(steps):
            parts.append(f"""{name}{k + 1} AS (
  SELECT f.* REPLACE (coalesce(sha256(s.l || f.folded || s.r), f.folded) AS folded, f.proof || coalesce(s.l || s.r, '') AS proof)
  FROM {name}{k} f LEFT JOIN {runs}{k} s ON s.lang IS NOT DISTINCT FROM f.in_tree AND s.i = f.{index} // {8 ** k})""")

    chain("l", "s", levels)
    parts.append("subroots AS (" + " UNION ALL ".join(f"SELECT lang, d FROM l{k} WHERE n = 1" for k in range(levels + 1)) + ")")
    parts.append("""tops AS (
  SELECT lang AS of_lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS spot, d, count(*) OVER () AS n FROM subroots)""")
    parts.append("t0 AS (SELECT CAST(NULL AS VARCHAR) AS lang, spot AS i, d, n FROM tops)")
    chain("t", "u", top_levels)
    parts.append("root AS (" + " UNION ALL ".join(f"SELECT d FROM t{k} WHERE n = 1" for k in range(top_levels + 1)) + ")")
    parts.append("""f0 AS (
  SELECT p.rid, p.doc_id, p.leaf, p.i, p.lang, p.lang AS in_tree, t.spot, t.d AS subroot, '' AS proof,
    CASE WHEN c.changed THEN p.lowered ELSE p.leaf END AS folded
  FROM placed p LEFT JOIN sums c ON c.rid = p.rid JOIN tops t ON t.of_lang IS NOT DISTINCT FROM p.lang)""")
    climb("f", "s", levels, "i")
    parts.append(f"g0 AS (SELECT * REPLACE (CAST(NULL AS VARCHAR) AS in_tree) FROM f{levels})")
    climb("g", "u", top_levels, "spot")
    return f"""WITH RECURSIVE {', '.join(parts)}
SELECT doc_id, leaf, subroot, (SELECT d FROM root) AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
  folded = (SELECT d FROM root) AS verified
FROM g{top_levels}"""


MERKLE = _merkle()
