"""SimHash near-duplicates, found through a table of distances to pivots.

Every distinct fingerprint x gets its Hamming distances D(x, p) to a fixed set
of reference fingerprints (pivots).  The pivots are one base value and, for
each of nine bit cells, several variants of the base with some bits of that
cell inverted, so ``D(x, p) - D(x, base)`` depends on the bits of one cell
only.  Three cells make a segment.  Two fingerprints that differ in at most
two bits agree in one of three segments, so they share that segment's distance
differences: joining on them is exact for a maximum distance of two.  Joined
pairs whose coordinates differ by more than the maximum anywhere are dropped
(triangle inequality), and the survivors are verified bit by bit.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, packed, row_digest
from tessera.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
CELLS = 9
PIVOTS_PER_CELL = 6
BUCKET_LIMIT = 1000


def _cell_bits(cell: int) -> list[int]:
    return list(range(cell * 64 // CELLS, (cell + 1) * 64 // CELLS))


def _pivots() -> tuple[int, list[list[int]]]:
    """The base fingerprint and, per cell, the pivots that differ from it there."""
    rng = random.Random(SEED)
    base = rng.getrandbits(64)
    cells = []
    for cell in range(CELLS):
        masks: set[int] = set()
        while len(masks) < PIVOTS_PER_CELL:
            bits = _cell_bits(cell)
            masks.add(sum(1 << b for b in rng.sample(bits, len(bits) // 2)))
        cells.append([base ^ m for m in sorted(masks)])
    return base, cells


def _signed(v: int) -> int:
    return v - (1 << 64) if v >= 1 << 63 else v


def _fingerprint(words: list[bytes], n: int) -> int:
    import numpy as np
    import xxhash

    if not words:
        return 0
    if len(words) < n:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(n))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 1 << 16):
        part = np.ascontiguousarray(h[at:at + (1 << 16)])
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """``(id_col, fp)``: the 64-bit SimHash of every whole text, as a signed long.

    Texts are lower-cased in A-Z and cut at ASCII white space into words;
    shingles of ``shingle`` words, repeats included, are hashed by XXH64 with
    seed 42; a bit is set if it is set in over half of the hashes.  A text with
    fewer words is one shingle; null, empty and blank texts have fingerprint 0.
    """
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([_signed(_fingerprint((t or b"").lower().split(), shingle)) for t in s], dtype="int64")

    fp = F.pandas_udf(run, "long")
    return docs.select(F.col(id_col), fp(F.col(text_col).cast("binary")).alias("fp"))


def _distance_table(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints with their distances to all pivots (``dist[0]``: the base)."""
    base, cells = _pivots()
    flat = [base] + [p for cell in cells for p in cell]
    dist = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(p)))).cast("tinyint") for p in flat])
    return fps.select("fp", dist.alias("dist"))


def _cells_key(cells: list[int], tag: int) -> Column:
    """A hash of the distance differences of some cells (collisions only add candidates)."""
    parts = []
    for c in cells:
        for j in range(PIVOTS_PER_CELL):
            parts.append(F.element_at("dist", 2 + c * PIVOTS_PER_CELL + j) - F.element_at("dist", 1))
    return F.xxhash64(F.lit(tag), *parts)


def _candidate_keys(table: DataFrame, limit: int) -> DataFrame:
    """Bucket keys: one for each segment; crowded buckets are refined.

    In a bucket with more than ``limit`` fingerprints, members agree in one
    segment; of the six cells left, taken as three pairs, one pair is again
    untouched for any linked two, so three finer keys replace the bucket's key
    and no link is lost.
    """
    segments = [[3 * s, 3 * s + 1, 3 * s + 2] for s in range(3)]
    keyed = table.select("fp", "dist", F.posexplode(F.array(
        *[_cells_key(cells, s) for s, cells in enumerate(segments)])).alias("seg", "key"))
    crowded = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("key", F.lit(True).alias("crowded"))
    keyed = keyed.join(crowded, "key", "left")
    finer = F.lit(None)
    for s, cells in enumerate(segments):
        rest = [c for c in range(CELLS) if c not in cells]
        pairs = [[rest[i], rest[i + 3]] for i in range(3)]
        fine = F.array(*[F.xxhash64("key", _cells_key(p, 10 + i)) for i, p in enumerate(pairs)])
        finer = F.when(F.col("seg") == s, fine).otherwise(finer)
    keys = F.when(F.col("crowded"), finer).otherwise(F.array("key"))
    return keyed.select("fp", "dist", F.explode(keys).alias("key"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, limit: int = BUCKET_LIMIT) -> DataFrame:
    """Links ``(u, v)``, u < v, between distinct fingerprints at most ``max_bits`` apart.

    ``fps`` has one row per fingerprint in column ``fp``.  ``max_bits`` may be
    0 to 2 (three segments find any two changed bits).
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    keys = _candidate_keys(_distance_table(fps), limit)
    a, b = keys.alias("a"), keys.alias("b")
    near = F.forall(F.zip_with("a.dist", "b.dist", lambda x, y: F.abs(x - y)), lambda d: d <= max_bits)
    same = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    return (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & near & same)
            .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).distinct())


def _grouped(marked: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root, least)`` of every distinct fingerprint; ``least``: its smallest id."""
    distinct = cut(marked.groupBy("fp").agg(F.min("id").alias("least")))
    found = connected_components(links(distinct.select("fp"), max_bits))
    return distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``(id_col, fp, component)`` for every row of ``docs``.

    ``component`` is the smallest id reachable over links of fingerprints at
    most ``max_bits`` apart, the row's own included; equal fingerprints are
    linked.  Copies are grouped first and only distinct fingerprints are
    compared.  Repeated rows and ids stay as rows; null ids are never a
    component unless all ids of the group are null; other columns are ignored.
    """
    marked = cut(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")),
                              "id", "text", shingle))
    grouped = _grouped(marked, max_bits)
    roots = grouped.groupBy("root").agg(F.min("least").alias("component"))
    named = grouped.join(roots, "root").select("fp", "component")
    return marked.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one of smallest id.

    Ties on the id go to the smaller digest of the whole row, null ids come
    last, and of rows equal in all columns one stays, so reruns agree and no
    group is lost whatever its ids.  The columns are those of ``docs``.
    """
    row = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("digest"))
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), row_digest(docs).alias("digest"))
    marked = cut(fingerprints(plain.select(row.alias("id"), "text"), "id", "text", shingle))
    kept = (_grouped(marked, max_bits).groupBy("root").agg(F.min("least").alias("k"))
            .select(F.col("k.digest").alias("digest")))
    return packed(docs, digest=row_digest(docs)).join(kept, "digest", "left_semi").dropDuplicates(["digest"]).select("doc.*")


def fingerprint_hex(fp: Column) -> Column:
    """16 lowercase hexadecimal digits of the unsigned fingerprint."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
