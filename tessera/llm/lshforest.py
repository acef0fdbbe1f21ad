"""MinHash near-duplicates through an LSH forest.

A document's set are its distinct word shingles.  Every distinct set gets a
signature of ``TREES * DEPTH`` minhashes; each run of ``DEPTH`` of them is one
order of the forest, by which the sets are sorted.  Sets next to each other in
an order share their longest prefix there, so neighbours are the first
candidates, the closest few of each set.  Confirmed links make components.

Then every region of an order, the sets that share a prefix of ``LEAST`` hashes,
is searched for pairs that are not in one component yet.  A region of more than
``REGION`` sets in several components gives way to the deeper ones within it;
where the order has no hash left it is dealt into a grid of blocks.  A region of
one component is done, so groups of thousands of near copies cost no pairs.
Comparisons take one byte of every minhash, which discards no more pairs than
the whole ones.  Signatures discard pairs that agree too rarely to be links (a link agrees less
once in 10^8 times); the sets of all others meet in their cell in full, and
pairs are confirmed there until no two components are left that a link joins.

A link of Jaccard 0.8 shares no region of 4 hashes in any of 16 orders with a
probability of 0.0002, a closer one less; this is the only chance to miss one,
but for regions that had to be deepened.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import cut, tasks_for
from tessera.llm.components import connected_components

SHINGLE = 4
PERCENT = 80            # least size of the intersection, in hundredths of the union
TREES = 16
DEPTH = 8
LEAST = 4
NEIGHBOURS = 2          # closest neighbours of a set that are tried first
REGION = 500
SHINGLES = 8000         # of a set on average; regions of longer ones are dealt into blocks
SEED = 20
AGREE = 0.6             # share of agreeing minhashes below which a pair is no candidate
CHUNK = 2048            # shingles hashed at a time
TEXTS = 256             # texts handled at a time
MEMO_WORDS = 500_000
KEYS_PER_RANGE = 250_000
BROADCAST_ROWS = 50_000     # of a few bytes each; larger sides are shuffled
WIDTH = 4 * DEPTH       # bytes of one tree's part of a signature


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, size=n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Words(dict):
    """Hashes of words; forgets all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word, SEED)
        return h


def shingle_hashes(text: bytes, memo: dict[bytes, int], n: int = SHINGLE) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes.

    Words stand between ASCII white space, A-Z are lower-cased; fewer than ``n``
    words are one shingle, none make no shingle.
    """
    words = text.lower().split()
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    # a text of fewer words is hashed with its length, so it equals no longer sequence
    width = min(n, len(h))
    at = len(h) - width + 1
    out = np.full(at, width, np.uint64)
    for k in range(width):
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + at])
    return np.unique(out)


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """Minhashes of a set, four big-endian bytes each, so bytewise order is their order."""
    least = np.full(len(a), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), CHUNK):
        np.minimum(least, ((hashes[lo:lo + CHUNK][None, :] ^ b[:, None]) * a[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(">u4").tobytes()


def _described(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows(id, h, text)`` as ``(id, h, n, print, sig)``: the set's size, a 128-bit hash of it, its signature."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        memo, a, b = _Words(), _odd(TREES * DEPTH, SEED), _odd(TREES * DEPTH, SEED + 1)
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                sizes, prints, signs = [], [], []
                for text in batch.column(2).to_pylist():
                    found = shingle_hashes(text or b"", memo, shingle)
                    sizes.append(len(found))
                    prints.append(xxhash.xxh3_128_digest(found.tobytes()))
                    signs.append(signature(found, a, b) if len(found) else b"")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())],
                    names=["id", "h", "n", "print", "sig"])

    return rows.mapInArrow(run, f"id {id_type}, h long, n long, print binary, sig binary")


def _neighbours(sets: DataFrame) -> DataFrame:
    """``(u, v, shared)``, u < v: the closest neighbours of every set in the sorted orders.

    ``shared`` adds up the hashes shared as prefixes over all orders.  Each range
    of an order is read once, in order; pairs across the border of two ranges
    are left to the search of the regions.
    """
    tree = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1)))
    keys = sets.select("sid", "sig", tree.alias("tree")).select(
        F.col("tree").cast("int").alias("tree"), F.expr(f"substring(sig, tree * {WIDTH} + 1, {WIDTH})").alias("part"), "sid")
    parts = max(1, math.ceil(sets.count() * TREES / KEYS_PER_RANGE))
    ordered = keys.repartitionByRange(parts, "tree", "part", "sid").sortWithinPartitions("tree", "part", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            trees, sids = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, DEPTH)
            if last is not None:
                trees, sids, sig = np.append(last[0], trees), np.append(last[1], sids), np.concatenate([last[2], sig])
            last = trees[-1:], sids[-1:], sig[-1:]
            shared = np.cumprod((sig[1:] == sig[:-1]) & (trees[1:] == trees[:-1])[:, None], axis=1).sum(axis=1)
            at = np.flatnonzero(shared >= LEAST)
            u, v = sids[at], sids[at + 1]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v)), pa.array(shared[at].astype(np.int64))],
                                             names=["u", "v", "shared"])

    pairs = ordered.mapInArrow(run, "u long, v long, shared long").groupBy("u", "v").agg(F.sum("shared").alias("shared"))
    ends = pairs.select("u", "v", "shared", F.explode(F.array("u", "v")).alias("end"))
    best = Window.partitionBy("end").orderBy(F.desc("shared"), "u", "v")        # a set has two neighbours in an order
    return ends.withColumn("place", F.row_number().over(best)).where(F.col("place") <= NEIGHBOURS).select("u", "v").distinct()


def _bytes(sig: pd.Series) -> pd.Series:
    """One byte of every minhash; equal ones have equal bytes, so they agree as often at least."""
    return sig.map(lambda s: s[3::4])


def _agreeing(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of equal minhashes of two signatures of a byte each."""
    p, q = (np.frombuffer(b"".join(x), np.uint8).reshape(len(x), TREES * DEPTH) for x in (a, b))
    return pd.Series((p == q).mean(axis=1))


def _marks(sets: DataFrame) -> DataFrame:
    """``(sid, n, sig)`` with a byte of each minhash."""
    return sets.select("sid", "n", F.pandas_udf(_bytes, "binary")("sig").alias("sig"))


def _size_fits(n: Column, m: Column) -> Column:
    return F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT


def _likely(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sizes and signatures allow a link."""
    marks = _marks(sets)
    a = marks.select(F.col("sid").alias("u"), F.col("n").alias("n_u"), F.col("sig").alias("s_u"))
    b = marks.select(F.col("sid").alias("v"), F.col("n").alias("n_v"), F.col("sig").alias("s_v"))
    both = pairs.join(a, "u").join(b, "v").where(_size_fits(F.col("n_u"), F.col("n_v")))
    return both.withColumn("agree", F.pandas_udf(_agreeing, "double")("s_u", "s_v")).where(F.col("agree") >= AGREE).select("u", "v")


def _placed(sets: DataFrame, comps: DataFrame) -> DataFrame:
    """``(sid, comp, n, tree, part)``: every set with its component in every order; ``part`` is its place there."""
    named = sets.join(comps, "sid", "left").select(
        "sid", F.coalesce("comp", "sid").alias("comp"), "n", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    return named.select("sid", "comp", "n", "tree", F.expr(f"substring(sig, tree * {WIDTH} + 1, {WIDTH})").alias("part"))


def _few(df: DataFrame, tasks: int | None) -> DataFrame:
    return df if tasks is None else df.coalesce(tasks)


def _cells(rows: DataFrame, sets: DataFrame, limit: int) -> DataFrame:
    """The regions of several components as ``(key, cell, own, sid, comp, n, sig)``; ``sig``: a byte of each minhash.

    A region of more than ``limit`` sets is replaced by the deeper ones within
    it.  One that is still too large at the last hash, or whose sets have more
    than ``limit * SHINGLES`` shingles, is dealt into blocks; a cell holds two
    of them, which ``own`` tells apart.
    """
    found, tasks = None, None
    for depth in range(LEAST, DEPTH + 1):
        keyed = rows.withColumn("key", F.xxhash64("tree", F.lit(depth), F.expr(f"substring(part, 1, {4 * depth})")))
        stats = keyed.groupBy("key").agg(F.count("*").alias("size"), F.sum("n").alias("weight"), F.min("comp").alias("one"), F.max("comp").alias("other"))
        stats = cut(_few(stats.where("one <> other").select(F.col("key").alias("k"), "size", "weight"), tasks))
        # most regions are done mostly, so their rows need not be shuffled
        side = F.broadcast(stats) if stats.count() <= BROADCAST_ROWS else stats
        keyed = cut(_few(keyed.join(side, F.col("key") == F.col("k")).drop("k"), tasks))
        small = keyed if depth == DEPTH else keyed.where(F.col("size") <= limit)
        small = small.select("key", "size", "weight", "sid", "comp")
        found = small if found is None else found.unionByName(small)
        if depth == DEPTH:
            break
        rows = keyed.where(F.col("size") > limit).select("sid", "comp", "n", "tree", "part")
        left = rows.count()
        if not left:
            break
        tasks = tasks_for(left)
        rows = _few(rows, tasks)
    blocks = F.greatest(F.ceil(F.col("size") / limit), F.ceil(F.col("weight") / (limit * SHINGLES)))
    blocks = F.least(blocks, F.col("size")).cast("int")
    dealt = found.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cell = F.least("own", "other").cast("long") * F.col("blocks") + F.greatest("own", "other")
    return dealt.select("key", cell.alias("cell"), "own", "sid", "comp").join(_marks(sets), "sid")


def _by_runs(rows: DataFrame, work: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """``work`` on every run of equal ``(key, cell)``, many runs a task, one in memory at a time."""
    names = rows.columns
    ordered = rows.repartition("key", "cell").sortWithinPartitions("key", "cell", "sid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] | None = None

        def cuts(c: dict[str, np.ndarray]) -> np.ndarray:
            return np.flatnonzero((c["key"][1:] != c["key"][:-1]) | (c["cell"][1:] != c["cell"][:-1])) + 1

        def done(c: dict[str, np.ndarray], at: np.ndarray) -> Iterator[pa.RecordBatch]:
            for lo, hi in zip(at[:-1], at[1:]):
                if hi - lo > 1:
                    out = work({k: v[lo:hi] for k, v in c.items()})
                    if len(next(iter(out.values()))):
                        yield pa.RecordBatch.from_arrays([pa.array(v) for v in out.values()], names=list(out))

        for batch in batches:
            if not batch.num_rows:
                continue
            now = {k: batch.column(i).to_numpy() if k != "sig"
                   else np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i, k in enumerate(names)}
            if kept is not None:
                now = {k: np.concatenate([kept[k], v]) for k, v in now.items()}
            at = np.concatenate([[0], cuts(now)])
            yield from done(now, at)
            kept = {k: v[at[-1]:] for k, v in now.items()}      # the last run may go on
        if kept is not None:
            yield from done(kept, np.array([0, len(kept["key"])]))

    return ordered.mapInArrow(run, schema)


def _likely_after(c: dict[str, np.ndarray], i: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions behind ``i`` in a cell whose sets may be links to its set across components, and their agreement."""
    n, m = c["n"][i], c["n"][i + 1:]
    fits = (c["comp"][i + 1:] != c["comp"][i]) & (np.minimum(n, m) * 100 >= np.maximum(n, m) * PERCENT)
    if c["own"].min() != c["own"].max():
        fits &= c["own"][i + 1:] != c["own"][i]
    at = np.flatnonzero(fits) + i + 1
    agree = (c["sig"][at] == c["sig"][i]).mean(axis=1) if len(at) else np.zeros(0)
    return at[agree >= AGREE], agree[agree >= AGREE]


def _involved(cells: DataFrame) -> DataFrame:
    """``(key, cell, own, sid, comp)``: the sets that may have a link to another component of their cell."""
    names = ("key", "cell", "own", "sid", "comp")

    def run(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        used = np.zeros(len(c["sid"]), bool)
        for i in range(len(used) - 1):
            at, _ = _likely_after(c, i)
            used[at] = True
            used[i] |= len(at) > 0
        return {k: c[k][used] for k in names}

    return _by_runs(cells, run, "key long, cell long, own int, sid long, comp long")


def _shingled(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows(sid, text)`` as ``(sid, shingles)``, one row for each sid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Words()
        for whole in batches:
            for at in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(at, TEXTS)
                # sorted as the signed numbers they are stored as
                found = [np.sort(shingle_hashes(t or b"", memo, shingle).view(np.int64)) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["sid", "shingles"])

    return rows.mapInArrow(run, "sid long, shingles array<long>").dropDuplicates(["sid"])


def _confirmed(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """The pairs that are links on their full sets; a set has few pairs here."""
    a = full.select(F.col("sid").alias("u"), F.col("shingles").alias("s_u"))
    b = full.select(F.col("sid").alias("v"), F.col("shingles").alias("s_v"))
    both = F.size(F.array_intersect("s_u", "s_v")).cast("long")
    whole = pairs.join(a, "u").join(b, "v").select("u", "v", both.alias("both"), (F.size("s_u") + F.size("s_v")).cast("long").alias("sizes"))
    return whole.where(F.col("both") * 100 >= (F.col("sizes") - F.col("both")) * PERCENT).select("u", "v")


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are a link."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return both * 100 >= (len(a) + len(b) - both) * PERCENT


def _confirmed_in_cells(involved: DataFrame, sets: DataFrame, full: DataFrame) -> DataFrame:
    """Links ``(u, v)`` of each cell: enough to join all components that links join there.

    A cell gets each of its sets once, however many pairs it is in, and no pair
    leaves it unless it is a link.  Pairs are tried from the likeliest on; one
    whose components are joined already tells nothing new and is left out.
    """
    wanted = cut(involved.select("sid").distinct())
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    marks = _marks(sets.join(side, "sid", "left_semi")).join(full.join(side, "sid", "left_semi"), "sid")
    members = involved.join(marks, "sid")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("sid")
        c = {k: group[k].to_numpy() for k in ("own", "sid", "comp", "n")}
        c["sig"] = np.frombuffer(b"".join(group["sig"]), np.uint8).reshape(len(group), -1)
        shingles = group["shingles"].tolist()
        pairs = [(i, *_likely_after(c, i)) for i in range(len(group) - 1)]
        left = np.concatenate([np.full(len(at), i) for i, at, _ in pairs] or [np.zeros(0, np.int64)])
        right, agree = (np.concatenate([p[k] for p in pairs] or [np.zeros(0)]) for k in (1, 2))
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = []
        comps, sids = c["comp"].tolist(), c["sid"].tolist()
        for k in np.argsort(-agree, kind="stable").tolist():
            i, j = int(left[k]), int(right[k])
            a, b = root(comps[i]), root(comps[j])
            if a != b and _linked(shingles[i], shingles[j]):
                parent[a] = b
                out.append((min(sids[i], sids[j]), max(sids[i], sids[j])))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")

    return members.groupBy("key", "cell").applyInPandas(run, "u long, v long").distinct()


def _merged(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``(sid, comp)`` after more links; ``comps`` lacks sets that are alone."""
    named = comps.withColumnRenamed("sid", "s")
    a = links.join(named, F.col("u") == F.col("s"), "left").select(F.coalesce("comp", "u").alias("u"), "v")
    b = a.join(named, F.col("v") == F.col("s"), "left").select("u", F.coalesce("comp", "v").alias("v"))
    over = connected_components(b.distinct()).withColumnRenamed("component", "above")
    moved = comps.join(over, F.col("comp") == F.col("node"), "left").select("sid", F.coalesce("above", "comp").alias("comp"))
    # sets that were alone are nodes of their own name
    fresh = over.join(comps.select("sid"), F.col("node") == F.col("sid"), "left_anti").select(F.col("node").alias("sid"), F.col("above").alias("comp"))
    return cut(moved.unionByName(fresh))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, region: int = REGION) -> DataFrame:
    """``(id_col, n_shingles, component)`` for every row of ``docs``.

    Sets of shingles are linked if their intersection has at least ``PERCENT``
    hundredths of their union's size; ``component`` is the smallest id reachable
    over links, the row's own included.  Null, empty and blank texts have no
    shingle and are linked with nothing, not with each other: their component is
    their own id.  Equal sets are linked and compared once.  Repeated rows and
    ids stay as rows; a null id is a component only where all ids of the group
    are null.  Other columns are ignored.
    """
    plain = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("binary").alias("text"))
    marked = cut(_described(plain, shingle))
    # one row for each distinct set; its smallest row stands for its text
    some = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("h").alias("h"))
    sets = marked.where("n > 0").groupBy("print").agg(F.min(some).alias("row"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    sets = cut(sets.withColumn("sid", F.monotonically_increasing_id()))

    full: DataFrame | None = None

    def with_texts(sids: DataFrame) -> DataFrame:
        """The sets in full; texts are read again only for sets not seen before."""
        nonlocal full
        needed = sids.distinct()
        if full is not None:
            needed = needed.join(full.select("sid"), "sid", "left_anti")
        wanted = cut(needed.join(sets, "sid").select("sid", F.col("row.id").alias("wid"), F.col("row.h").alias("wh")))
        n = wanted.count()
        if not n:
            return full
        side = F.broadcast(wanted) if n <= BROADCAST_ROWS and full is not None else wanted
        texts = plain.join(side, F.col("id").eqNullSafe(F.col("wid")) & (F.col("h") == F.col("wh"))).select("sid", "text")
        more = cut(_shingled(texts, shingle))
        full = more if full is None else full.unionByName(more)
        return full

    comps = cut(sets.select("sid", F.col("sid").alias("comp")).limit(0))
    pairs = cut(_likely(_neighbours(sets.select("sid", "sig")), sets))
    if not pairs.isEmpty():
        comps = _merged(comps, cut(_confirmed(pairs, with_texts(pairs.select(F.explode(F.array("u", "v")).alias("sid"))))))
    involved = cut(_involved(_cells(_placed(sets, comps), sets, region)))
    if not involved.isEmpty():
        comps = _merged(comps, cut(_confirmed_in_cells(involved, sets, with_texts(involved.select("sid")))))
    grouped = sets.join(comps, "sid", "left").select("print", F.col("row.id").alias("least"), F.coalesce("comp", "sid").alias("comp"))
    names = grouped.groupBy("comp").agg(F.min("least").alias("component"))
    named = grouped.join(names, "comp").select("print", "component")
    alone = marked.where("n = 0").select("id", "n", F.col("id").alias("component"))
    rows = marked.where("n > 0").join(named, "print").select("id", "n", "component").unionByName(alone)
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component")
