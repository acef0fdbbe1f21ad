"""Secrets in texts: fixed patterns, and a battery of randomness tests.

Three fixed kinds (assignments, access keys, hexadecimal runs) are matched as
they stand.  Other long tokens, and the long parts of tokens between ``/``, ``_``
and ``-``, are tested for randomness: from its characters
each token's encoding is inferred (hexadecimal, letters and digits of one case,
base 64), and against that alphabet three tests are made: chi-squared
uniformity of the characters, the number of runs of character classes
(upper, lower, digit, sign), and serial correlation.  The chance that the least
of three uniform p-values is as small as the least of these (Sidak) is the
token's p-value under "random".

Ordinary words fail the battery and secrets pass it, but a short token may pass
by chance.  The cut-off is therefore set for every encoding and length band
from the p-values of the distinct tokens of the whole corpus, so copies of a
token count once: truly random tokens have uniform p-values, so those above
``RANDOM_ABOVE`` tell how many there are, and everything else that a cut-off
keeps is a false discovery.  Cut-offs lie below that value.  The least one with
an estimated rate within ``FALSE_RATE`` holds; a band without one finds nothing.

Only column expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, packed
from tessera.llm.spans import let, match_spans, running, stretch, text_chunks

# fixed values of the task: kinds in order, their patterns and least lengths
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

# tokens that the battery tests
TOKEN_LEAST = 16
PADDING = r"(?:={1,2}(?![A-Za-z0-9+/_=-]))?"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}+" % TOKEN_LEAST + PADDING
# the parts of a token between '/', '_' and '-', tested too
PART = r"(?<![A-Za-z0-9+])[A-Za-z0-9+]{%d,}+" % TOKEN_LEAST + PADDING
FALSE_RATE = 0.05
BANDS = [20, 28, 40, 64]
EDGES = [0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5]
RANDOM_ABOVE = 0.3      # p-values above it count the random tokens; cut-offs lie below it
UPPER, LOWER, DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
# encodings: name, characters (a token belongs to the first that has all of its characters)
ENCODINGS = [
    ("hex", DIGITS + "abcdef"),
    ("HEX", DIGITS + "ABCDEF"),
    ("upper36", DIGITS + UPPER),
    ("lower36", DIGITS + LOWER),
    ("base64", UPPER + LOWER + DIGITS + "+/-_"),
]


def _class_change(alphabet: str) -> float:
    """Chance that two random characters of an alphabet differ in class."""
    sizes = [sum(c in s for c in alphabet) for s in (UPPER, LOWER, DIGITS)]
    sizes.append(len(alphabet) - sum(sizes))
    return 1 - sum((s / len(alphabet)) ** 2 for s in sizes)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal, by the logistic approximation."""
    z = F.least(F.greatest(z, F.lit(-12.0)), F.lit(12.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(1.5976) * z + F.lit(0.07056) * z * z * z))


def _encoding(value: Column) -> Column:
    """Index of the inferred encoding; null for tokens of digits only (numbers)."""
    out = F.lit(len(ENCODINGS) - 1)
    for i in range(len(ENCODINGS) - 2, -1, -1):
        out = F.when(F.length(F.translate(value, ENCODINGS[i][1], "")) == 0, F.lit(i)).otherwise(out)
    return F.when(value.rlike("[^0-9]"), out)


def _by_encoding(encoding: Column, values: list[float]) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), encoding + 1)


def randomness(value: Column, encoding: Column) -> Column:
    """p-value of a token under "characters drawn at random from its encoding"."""
    alphabets = [a for _, a in ENCODINGS]
    n = F.length(value).cast("double")
    k = _by_encoding(encoding, [len(a) for a in alphabets])
    alphabet = F.element_at(F.array(*[F.lit(a) for a in alphabets]), encoding + 1)
    at = F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.instr(alphabet, F.substring(value, i, F.lit(1))).cast("double"))
    classes = F.translate(value, UPPER + LOWER + DIGITS + "+/-_", "U" * 26 + "L" * 26 + "D" * 10 + "SSSS")

    def battery(x: Column, cls: Column) -> Column:
        total = F.lit(0.0)
        pairs = F.arrays_zip(F.slice(x, F.lit(1), F.size(x) - 1).alias("a"), F.slice(x, F.lit(2), F.size(x) - 1).alias("b"))
        squares = F.aggregate(F.array_distinct(x), total, lambda s, d: s + F.pow(F.size(F.filter(x, lambda y: y == d)).cast("double"), F.lit(2.0)))
        chi = k / n * squares - n
        chi_z = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        changes = F.aggregate(F.sequence(F.lit(1), F.size(x) - 1), total, lambda s, i: s + F.when(
            F.substring(cls, i, F.lit(1)) != F.substring(cls, i + 1, F.lit(1)), 1.0).otherwise(0.0))
        q = _by_encoding(encoding, [_class_change(a) for a in alphabets])
        run_z = (changes - (n - 1) * q) / F.sqrt((n - 1) * q * (1 - q))
        mean = F.aggregate(x, total, lambda s, y: s + y) / n
        spread = F.aggregate(x, total, lambda s, y: s + (y - mean) * (y - mean))
        lagged = F.aggregate(pairs, total, lambda s, p: s + (p["a"] - mean) * (p["b"] - mean))
        serial_z = F.when(spread > 0, (lagged / spread + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
        least = F.least(_upper_tail(chi_z), 2 * _upper_tail(F.abs(run_z)), 2 * _upper_tail(F.abs(serial_z)))
        return 1 - F.pow(1 - F.least(F.lit(1.0), least), F.lit(3.0))

    # one-element transforms name the intermediate arrays, so they are made once
    named = F.transform(F.array(F.struct(at.alias("x"), classes.alias("c"))), lambda s: battery(s["x"], s["c"]))
    return F.element_at(named, 1)


def _band(length: Column) -> Column:
    out = F.lit(len(BANDS))
    for i in range(len(BANDS) - 1, -1, -1):
        out = F.when(length < BANDS[i], F.lit(i)).otherwise(out)
    return out


def base_spans(text: Column) -> Column:
    """Array of ``(start, kind number, kind, end)`` of the fixed kinds, in order."""
    def kind(number: int, name: str, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("number"), F.lit(name).alias("kind"), s["end"].alias("end")))

    assign = F.filter(match_spans(text, ASSIGN, 2), lambda s: F.length(s["value"]) >= ASSIGN_LEAST)
    access = F.filter(match_spans(text, ACCESS), lambda s: F.length(s["value"]) >= ACCESS_LEAST)
    return F.array_sort(F.concat(kind(0, "assign", assign), kind(1, "access", access), kind(2, "hex", match_spans(text, HEX))))


def tested_tokens(text: Column) -> Column:
    """Array of ``(start, end, encoding, band, p, h)`` of the tokens the battery tests; ``h`` is the value's hash.

    A token is tested whole and by its long parts between ``/``, ``_`` and ``-``;
    ``=`` is only part of it as padding at its end, which is not tested.
    """
    def test(s: Column) -> Column:
        value = F.rtrim(s["value"], F.lit("="))
        code = _encoding(value)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), code.alias("encoding"),
                        _band(F.length(value)).alias("band"),
                        F.when(code.isNotNull(), randomness(value, code)).alias("p"), F.xxhash64(value).alias("h"))

    # a token without a separator is a part of its own
    whole = F.filter(match_spans(text, TOKEN), lambda s: s["value"].rlike("[/_-]"))
    found = F.concat(match_spans(text, PART), whole)
    return F.filter(F.transform(found, test), lambda t: t["p"].isNotNull())


def mark(rows: DataFrame) -> DataFrame:
    """``rows`` with columns ``base`` and ``tested`` from ``text``; a null text is an empty one."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.withColumns({"base": base_spans(text), "tested": tested_tokens(text)})


def cutoffs(tested: DataFrame, false_rate: float = FALSE_RATE) -> dict[tuple[int, int], float]:
    """Cut-off of p for every (encoding, band) that has one, from all distinct tested tokens.

    The counts that reach the driver are those of the fixed encodings, bands
    and edges: at most 5 x 5 x 11 rows, whatever the corpus.
    """
    p = F.col("t.p")
    bin_ = F.lit(len(EDGES))
    for i in range(len(EDGES) - 1, -1, -1):
        bin_ = F.when(p <= EDGES[i], F.lit(i)).otherwise(bin_)
    counts = (tested.select(F.explode("tested").alias("t"))
              .select(F.col("t.encoding").alias("encoding"), F.col("t.band").alias("band"), bin_.alias("bin"), F.col("t.h").alias("h")).distinct()
              .groupBy("encoding", "band", "bin").agg(F.count("*").alias("n")).collect())
    tables: dict[tuple[int, int], list[int]] = {}
    for r in counts:
        tables.setdefault((r["encoding"], r["band"]), [0] * (len(EDGES) + 1))[r["bin"]] = r["n"]
    out = {}
    for key, bins in tables.items():
        random_ones = sum(bins[EDGES.index(RANDOM_ABOVE) + 1:]) / (1 - RANDOM_ABOVE)
        for i, edge in enumerate(EDGES[:EDGES.index(RANDOM_ABOVE)]):
            kept = sum(bins[i + 1:])
            if kept and 1 - random_ones * (1 - edge) / kept <= false_rate:
                out[key] = edge
                break
    return out


SECRET = "array<struct<start:bigint,number:int,kind:string,end:bigint>>"


def _outermost(spans: Column) -> Column:
    """Of spans that lie within each other or apart the outer ones, by start."""
    # the longer of two with the same start comes first
    ordered = F.transform(F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back")))),
                          lambda s: F.struct(s["start"].alias("start"), (-s["back"]).alias("end")))

    def outer(sorted_spans: Column) -> Column:
        reached = running(F.transform(sorted_spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y))
        both = F.filter(F.arrays_zip(sorted_spans.alias("s"), reached.alias("r")), lambda x: x["s"]["end"] > x["r"])
        return F.transform(both, lambda x: x["s"])

    return let(ordered, outer)


def _uncovered(spans: Column, covers: Column) -> Column:
    """The stretches of ``spans`` (apart from each other) that no cover overlaps, in order.

    All starts and ends are sorted; between two of them the numbers of open
    spans and open covers are running sums, held as the two halves of a long.
    """
    half = 1 << 32

    def edges(of: Column, weight: int) -> Column:
        opens = F.transform(of, lambda s: F.struct(s["start"].alias("at"), F.lit(-weight).cast("bigint").alias("less")))
        return F.concat(opens, F.transform(of, lambda s: F.struct(s["end"].alias("at"), F.lit(weight).cast("bigint").alias("less"))))

    def between(marks: Column) -> Column:
        # at equal places starts come first, so no sum is negative
        state = running(F.transform(marks, lambda m: -m["less"]), lambda x, y: x + y)
        at = F.transform(marks, lambda m: m["at"])
        pieces = F.arrays_zip(F.concat(F.array(F.lit(0).cast("bigint")), F.slice(at, F.lit(1), F.size(at) - 1)).alias("start"), at.alias("end"), state.alias("open"))
        return F.filter(pieces, lambda p: (p["open"] >= half) & (p["open"] % half == 0) & (p["end"] > p["start"]))

    return let(F.array_sort(F.concat(edges(spans, half), edges(covers, 1))), between)


def all_spans(limits: dict[tuple[int, int], float]) -> Column:
    """From columns ``base`` and ``tested``: base spans and what the random tokens have beside them, in order.

    A part of a random token is left out.  Where a random token overlaps base
    spans, each stretch of it that they leave uncovered is a span.
    """
    if not limits:
        return F.array_sort(F.col("base"))

    def passes(t: Column) -> Column:
        limit = F.lit(2.0)
        for (encoding, band), p in sorted(limits.items()):
            limit = F.when((t["encoding"] == encoding) & (t["band"] == band), F.lit(p)).otherwise(limit)
        return t["p"] > limit

    def kept(random: Column) -> Column:
        beside = F.transform(_uncovered(_outermost(random), F.col("base")), lambda p: F.struct(
            p["start"].alias("start"), F.lit(3).alias("number"), F.lit("random").alias("kind"), p["end"].alias("end")))
        return F.when(F.size(random) > 0, beside).otherwise(F.array().cast(SECRET))

    return F.array_sort(F.concat("base", let(F.filter("tested", passes), kept)))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 false_rate: float = FALSE_RATE) -> DataFrame:
    """``(id_col, base, spans)`` for every row of ``docs``.

    Both are arrays of ``(start, number, kind, end)`` in code points, ordered by
    start and kind; ``spans`` has those of ``base`` and, beside them, the random tokens.  Null
    and empty texts have none.  Repeated rows stay; other columns are ignored.
    The marked spans are cut in the shared checkpoint folder, so every text is
    searched once.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    marked = cut(mark(plain).drop("text"))
    spans = all_spans(cutoffs(marked, false_rate))
    return marked.select(F.col("id").alias(id_col), "base", spans.alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
           false_rate: float = FALSE_RATE, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret of the text replaced by ``mask``.

    All rows and columns stay; texts without secrets are unchanged, null stays
    null.  Overlapping spans are masked together.  ``length_col``, if the table
    has it, is set to the new number of code points where a text changed.  Every
    text is searched once: the marked spans of each distinct text that has some
    are cut in the shared checkpoint folder, and meet the rows by the text's SHA-256.
    """
    key = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    found = mark(docs.select(F.col(text_col).alias("text"))).withColumn("key", key).drop("text")
    found = cut(found.where((F.size("base") > 0) | (F.size("tested") > 0)).dropDuplicates(["key"]))
    limits = cutoffs(found, false_rate)
    none = {c: F.coalesce(F.col(c), F.array().cast(found.schema[c].dataType)) for c in ("base", "tested")}
    marked = packed(docs, text=F.col(text_col)).withColumn("key", key).join(found, "key", "left").withColumns(none)
    text = F.col("text")

    def masked(s: Column) -> Column:
        """The text between the spans, each group of overlapping ones replaced."""
        spans, pieces = s["spans"], s["pieces"]
        ends = F.transform(spans, lambda x: x["end"])
        reached = running(ends, lambda x, y: F.greatest(x, y))
        gaps = F.transform(F.filter(F.arrays_zip(spans.alias("s"), reached.alias("r")), lambda x: x["s"]["start"] >= x["r"]),
                           lambda x: F.concat(stretch(pieces, x["r"], x["s"]["start"]), F.lit(mask)))
        rest = stretch(pieces, F.array_max(ends), F.length(text).cast("bigint"))
        return F.concat(F.array_join(gaps, ""), rest)

    done = marked.withColumn("spans", all_spans(limits)).withColumn("changed", (F.size("spans") > 0) & text.isNotNull())
    named = let(F.struct(F.col("spans").alias("spans"), text_chunks(text).alias("pieces")), masked)
    done = done.withColumn("text", F.when(F.col("changed"), named).otherwise(text))
    doc = F.col("doc").withField(f"`{text_col}`", F.col("text"))
    if length_col and length_col in docs.columns:
        length = F.when(F.col("changed"), F.length("text")).otherwise(F.col(f"doc.`{length_col}`"))
        doc = doc.withField(f"`{length_col}`", length.cast(docs.schema[length_col].dataType))
    return done.select(doc.alias("doc")).select("doc.*")


def digest(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
