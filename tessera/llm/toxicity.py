"""Toxicity by a support vector machine over a subsequence string kernel.

Two words are compared by the character subsequences they share: every
subsequence of three characters within a window counts with a weight that
decays with the window it takes, so gaps and inserted characters cost
similarity but do not end it.  The kernel is normalised and approximated on
landmark words (Nyström), and a linear SVM is trained on the words of labelled
sentences: a sentence of a toxic document is toxic through one word, its
witness, which is chosen anew in every round (multiple-instance training); all
words of clean sentences are negatives, the hardest ones added in every round.
A text's score is the calibrated value of its most toxic words.  Runs of single
characters ("i d i o t") are read as words too.

The model is fitted on the driver on a bounded sample of labelled rows, at
most ``SAMPLE_DOCS`` of each label and ``SAMPLE_CHARS`` characters each; it is
one table of fixed size that the tasks get.  Every row of the corpus is scored
on its whole text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import packed

WINDOW = 6              # characters that a subsequence of three may span
DECAY = 0.6
TABLE_BITS = 20         # hashed subsequences
PIECE = 24              # longer words are read in overlapping pieces of this length
LANDMARKS = 160
ROUNDS = 4
DISGUISES = 4
COST = 2_000.0          # total weight of either side in the SVM
TOP = 3                 # most toxic words that a text's score is calibrated on
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 20_000
NEGATIVES = 12_000
HARD_NEGATIVES = 3_000
THRESHOLD = 0.3
MEMO_WORDS = 400_000
ROWS_PER_BATCH = 512
CHUNK = 1_024
SLICE = 16_384          # words whose readings are held at a time
CELLS = 1 << 20         # numbers of a dense block, at most

SPACED = re.compile(r"(?<!\S)(?:\S ){2,}\S(?!\S)")
SIGNS = re.compile(r"[\W_]+")
EDGE = re.compile(r"^\W+|\W+$")
STEPS = [(a, b) for b in range(2, WINDOW) for a in range(1, b)]
MULTIPLIERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)     # odd constants of the hash


def _bare(word: str) -> str:
    """The word between marks for its ends, without punctuation around it."""
    return "\x02" + EDGE.sub("", word) + "\x03"


def _pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    half = PIECE // 2
    return [word[i:i + PIECE] for i in range(0, len(word) - half, half)]


def _subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed subsequences and their windows for every word: (n, k) codes, window 0 where none."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    width = int(sizes.max())
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    chars = np.zeros((len(words), width + WINDOW), dtype=np.uint32)
    chars[np.arange(width + WINDOW)[None, :] < sizes[:, None]] = flat
    m0, m1, m2 = (np.uint32(m) for m in MULTIPLIERS)
    first = chars[:, :width] * m0
    second, third = chars * m1, chars * m2
    codes, spans = [], []
    at = np.arange(width)[None, :]
    for a, b in STEPS:
        h = first + second[:, a:a + width] + third[:, b:b + width]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        codes.append(h >> np.uint32(32 - TABLE_BITS))
        spans.append(np.where(at + b < sizes[:, None], b + 1, 0).astype(np.uint32))
    return np.concatenate(codes, axis=1), np.concatenate(spans, axis=1)


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sparse normalised feature vectors: (row starts, codes, values, row of each value)."""
    codes, spans = _subsequences(words)
    packed = np.sort((codes << np.uint32(3)) | spans, axis=1)
    n, k = packed.shape
    code = (packed >> np.uint32(3)).ravel()
    weight = np.concatenate([[0.0], DECAY ** np.arange(1, 8)])[packed & np.uint32(7)].ravel()
    row = np.repeat(np.arange(n), k)
    start = np.empty(n * k, dtype=bool)
    start[0] = True
    np.not_equal(code[1:], code[:-1], out=start[1:])
    start[::k] = True
    at = np.flatnonzero(start)
    value = np.add.reduceat(weight, at)
    code, row = code[at], row[at]
    norm = np.sqrt(np.bincount(row, value * value, n))
    value = value / np.maximum(norm, 1e-12)[row]
    return code, value, row


def _score_pieces(words: list[str], table: np.ndarray) -> np.ndarray:
    """Inner products of the words' normalised vectors with a table."""
    out = np.zeros(len(words))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for lo in range(0, len(words), CHUNK):
        part = order[lo:lo + CHUNK]
        code, value, row = _features([words[i] for i in part])
        out[part] = np.bincount(row, table[code] * value, len(part))
    return out


def _readings(word: str) -> list[str]:
    """The word as it stands and, if signs break it up, without them; in pieces if long."""
    bare = _bare(word)
    joined = bare if bare[1:-1].isalnum() else "\x02" + SIGNS.sub("", bare[1:-1]) + "\x03"
    return _pieces(bare) + (_pieces(joined) if joined != bare else [])


def word_values(words: list[str], table: np.ndarray) -> np.ndarray:
    """The SVM's value (without bias) of each word: the highest of its readings."""
    out = np.full(len(words), -np.inf)
    for lo in range(0, len(words), SLICE):
        pieces, owner = [], []
        for i, w in enumerate(words[lo:lo + SLICE], lo):
            for p in _readings(w):
                pieces.append(p)
                owner.append(i)
        np.maximum.at(out, np.array(owner), _score_pieces(pieces, table))
    return out


def text_words(text: str) -> set[str]:
    """The distinct words of a text, with runs of single characters joined."""
    low = text.lower()
    words = set(low.split())
    if " " in low:
        for m in SPACED.finditer(low):
            words.add(m.group().replace(" ", ""))
    return words


@dataclass(frozen=True)
class ToxicityModel:
    table: np.ndarray       # weight of every hashed subsequence
    bias: float
    weights: np.ndarray     # calibration: of the TOP highest word values, log word count, constant

    def pooled(self, texts: list[np.ndarray]) -> np.ndarray:
        """Calibration inputs of texts, each given by the values of its words."""
        x = np.zeros((len(texts), TOP + 2))
        x[:, :TOP] = FLOOR
        for i, values in enumerate(texts):
            top = np.sort(np.partition(values, -TOP)[-TOP:] if len(values) > TOP else values)[::-1]
            x[i, :len(top)] = np.maximum(top + self.bias, FLOOR)
            x[i, TOP] = np.log1p(len(values))
        x[:, TOP + 1] = 1
        return x

    def probability(self, texts: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.pooled(texts) @ self.weights, -30, 30)))


FLOOR = -2.0


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 40) -> np.ndarray:
    """Linear SVM with squared hinge loss by Newton steps; the last column is constant, its weight the bias."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(steps):
        gap = 1 - y * (x @ w)
        on = np.flatnonzero(gap > 0)
        g, h = ridge @ w, ridge.copy()
        for lo in range(0, len(on), CHUNK):
            part = on[lo:lo + CHUNK]
            rows = x[part]
            g -= 2 * (rows.T @ (weight[part] * y[part] * gap[part]))
            h += 2 * (rows.T * weight[part]) @ rows
        step = np.linalg.solve(h, g)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


class _Landmarks:
    """Normalised kernel values of words with some landmark words."""

    def __init__(self, words: list[str]):
        code, value, row = _features(words)
        self.codes, col = np.unique(code, return_inverse=True)
        self.rows = np.zeros((len(words), len(self.codes)))
        np.add.at(self.rows, (row, col), value)

    def kernel(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), len(self.rows)))
        self.project(words, np.eye(len(self.rows)), out)
        return out

    def project(self, words: list[str], root: np.ndarray, out: np.ndarray) -> None:
        """The kernel values of the words times ``root``, written into ``out``."""
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        # long landmarks have many subsequences: a block is bounded by its cells, not by its rows
        step = max(1, min(CHUNK, CELLS // len(self.codes)))
        for lo in range(0, len(words), step):
            part = order[lo:lo + step]
            code, value, row = _features([words[i] for i in part])
            col = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[col] == code
            dense = np.zeros((len(part), len(self.codes)))
            np.add.at(dense, (row[hit], col[hit]), value[hit])
            out[part] = dense @ self.rows.T @ root

    def collapse(self, alpha: np.ndarray) -> np.ndarray:
        """The weighted sum of the landmarks as one table over hashed subsequences."""
        table = np.zeros(1 << TABLE_BITS)
        table[self.codes] = alpha @ self.rows
        return table


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a ridge logistic regression, by damped Newton steps."""
    # Platt's targets keep the fit finite when the classes separate
    pos, neg = max(1.0, (y == 1).sum()), max(1.0, (y == 0).sum())
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 1e-2
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - t)) + ridge @ w
        h = (x.T * (weight * np.maximum(p * (1 - p), 1e-4))) @ x + ridge
        step = np.linalg.solve(h, g)
        w = w - step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _disguises(word: str, rng: np.random.Generator) -> list[str]:
    """The word with a letter doubled, a sign put in, a letter put in, and one replaced."""
    n = len(word)
    at = rng.integers(1, max(2, n), size=DISGUISES)
    letter = [chr(ord("a") + int(i)) for i in rng.integers(0, 26, size=DISGUISES)]
    return [word[:at[0]] + word[at[0] - 1] + word[at[0]:], word[:at[1]] + "*" + word[at[1]:],
            word[:at[2]] + letter[2] + word[at[2]:], word[:at[3]] + letter[3] + word[at[3] + 1:]]


def _parts(word: str) -> set[str]:
    marked = "\x02" + EDGE.sub("", word)
    return {marked[i:i + 5] for i in range(max(1, len(marked) - 4))}


def _start_values(toxic: list[set[str]], clean: list[set[str]]) -> tuple[dict[str, float], dict[str, float]]:
    """Log odds of a toxic text for a word and its best part, before any training, and those of the parts."""
    def counts(bags, of, among=None):
        return Counter(x for b in bags for x in set().union(*map(of, b)) if among is None or x in among)

    def odds(x, t, c):
        return float(np.log((t[x] + 0.1) / (len(toxic) + 0.2)) - np.log((c[x] + 0.1) / (len(clean) + 0.2)))

    # of the clean texts only what occurs in a toxic one is looked up
    word_t = Counter(w for b in toxic for w in b)
    word_c = Counter(w for b in clean for w in b if w in word_t)
    part_t = counts(toxic, _parts)
    part_c = counts(clean, _parts, part_t)
    part = {p: odds(p, part_t, part_c) for p in part_t}
    return {w: odds(w, word_t, word_c) + max(part[p] for p in _parts(w)) for w in word_t}, part


def _leading_pieces(words: list[str], table: np.ndarray | None, part: dict[str, float]) -> list[str]:
    """Of each word the piece that speaks most for a toxic text: by the table, or by its parts before there is one."""
    pieces = [_pieces(_bare(w)) for w in words]
    if table is None:
        def worth(p: str) -> float:
            return max((part.get(p[i:i + 5], 0.0) for i in range(max(1, len(p) - 4))), default=0.0)
        return [max(own, key=worth) for own in pieces]
    flat = [p for own in pieces for p in own]
    value = iter(_score_pieces(flat, table).tolist() if flat else [])
    return [max([(next(value), -k, p) for k, p in enumerate(own)])[2] for own in pieces]


def _bags(texts: Iterable[str], names: dict[str, str]) -> list[set[str]]:
    """The words of each text that has any; a word of many texts is held once, in ``names``."""
    bags = ({names.setdefault(w, w) for w in text_words(t)} for t in texts)
    return [b for b in bags if b]


def fit(toxic: Iterable[str], clean: Iterable[str], clean_share: float = 0.9, seed: int = 7) -> ToxicityModel:
    """A model from labelled texts; ``clean_share`` is that of clean rows in the population.

    Without texts of both labels the model gives every text the same score.
    """
    rng = np.random.default_rng(seed)
    names: dict[str, str] = {}
    bags, calm = _bags(toxic, names), _bags(clean, names)
    del names
    if not bags or not calm:
        constant = np.zeros(TOP + 2)
        constant[-1] = -3.0 if not bags else 3.0
        return ToxicityModel(np.zeros(1 << TABLE_BITS, np.float32), 0.0, constant)
    # a quarter of the sample calibrates
    hold_t, hold_c = bags[::4], calm[::4]
    fit_t = [b for i, b in enumerate(bags) if i % 4] or bags
    fit_c = [b for i, b in enumerate(calm) if i % 4] or calm
    df_c = Counter(w for b in fit_c for w in b)
    clean_words = sorted(df_c)
    toxic_words = sorted(set().union(*fit_t))
    frequent = sorted(df_c, key=lambda w: (-df_c[w], w))
    value, part = _start_values(fit_t, fit_c)
    # frequent words are always among the negatives, the others by chance
    chosen = frequent[:NEGATIVES // 4]
    chosen += [clean_words[i] for i in rng.permutation(len(clean_words))[:NEGATIVES - len(chosen)]]
    hard: list[str] = []
    table = None
    for turn in range(ROUNDS):
        witness = Counter()
        for b in fit_t:
            ranked = sorted(b, key=lambda w: (-value[w], w))[:2]
            # the second word counts as a witness once the machine takes it for toxic
            witness.update(ranked[:1] + [w for w in ranked[1:] if turn and value[w] + bias > 0.5])
        known = sorted(witness, key=lambda w: (-witness[w], w))
        share = LANDMARKS // 4
        names = list(dict.fromkeys(_leading_pieces(known[:2 * share] + frequent[:share] + hard[:share], table, part)))
        marks = _Landmarks(names)
        vals, vecs = np.linalg.eigh(marks.kernel(names))
        root = vecs @ np.diag(1 / np.sqrt(np.maximum(vals, 1e-3))) @ vecs.T
        negatives = list(dict.fromkeys(chosen + hard))
        # a witness is read by its leading piece, a word of a clean sentence by all of its pieces
        calm_pieces = [(p, df_c[w]) for w in negatives for p in _pieces(_bare(w))]
        # disguises of the surest witnesses are positives too, at a lower weight
        disguised = [(v, witness[w] / 100) for w in known if witness[w] >= 3 for v in _disguises(w, rng)]
        read = (_leading_pieces(known, table, part) + [p for p, _ in calm_pieces]
                + _leading_pieces([v for v, _ in disguised], table, part))
        # a row more: a word that is like no landmark; a column more: constant, for the bias
        x = np.zeros((len(read) + 1, len(names) + 1))
        x[:, -1] = 1
        marks.project(read, root, x[:-1, :-1])
        y = np.concatenate([np.ones(len(known)), -np.ones(len(calm_pieces)), np.ones(len(disguised))])
        up = np.sqrt(np.array([witness[w] for w in known], dtype=float))
        down = np.sqrt(np.array([n for _, n in calm_pieces], dtype=float))
        # both sides weigh the same; words count by the root of their documents
        extra = np.sqrt(np.array([n for _, n in disguised], dtype=float))
        weight = np.concatenate([up / up.sum(), down / down.sum(), extra / up.sum()]) * COST
        # a word that is like no landmark is not toxic
        y, weight = np.append(y, -1.0), np.append(weight, COST / 10)
        w = _svm(x, y, weight)
        bias = float(w[-1])
        table = marks.collapse(root @ w[:-1])
        value = dict(zip(toxic_words, word_values(toxic_words, table)))
        risk = word_values(clean_words, table) + np.array([0.1 * np.log(df_c[w]) for w in clean_words])
        hard = [clean_words[i] for i in np.argsort(-risk, kind="stable")[:HARD_NEGATIVES]]
    model = ToxicityModel(table.astype(np.float32), bias, np.zeros(TOP + 2))
    held = hold_t + hold_c
    every = sorted(set().union(*held))
    memo = dict(zip(every, word_values(every, table)))
    x = model.pooled([np.array([memo[w] for w in h]) for h in held])
    y = np.concatenate([np.ones(len(hold_t)), np.zeros(len(hold_c))])
    share = min(max(clean_share, 0.01), 0.99)
    weight = np.where(y == 1, (1 - share) / max(1, len(hold_t)), share / max(1, len(hold_c))) * len(y)
    return ToxicityModel(model.table, bias, _logistic(x, y, weight))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", keep=None) -> ToxicityModel:
    """Fit on a bounded sample of labelled rows (all, if there are fewer).

    ``keep`` is a condition on the id column of the labels.  The rows of a label
    are taken in the order of their id's hash; texts over ``SAMPLE_CHARS``
    characters are not used for fitting.  Null texts and labels are left out; an
    id with several labels counts as toxic if one of them is.
    """
    marked = labels.where(F.col(label_col).isin(0, 1))
    if keep is not None:
        marked = marked.where(keep)
    marked = marked.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    text = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") <= SAMPLE_CHARS)
    drawn = []
    for label in (1, 0):
        # twice the bound of ids, as some texts may be missing or too long; so many ids are broadcast
        some = marked.where(F.col("toxic") == label).select("id", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(2 * SAMPLE_DOCS)
        rows = text.join(F.broadcast(some), "id").orderBy("h", "id", "text").limit(SAMPLE_DOCS).select("text").collect()
        drawn.append([r["text"] for r in rows])
    total = sum(counts.values())
    return fit(drawn[0], drawn[1], counts.get(0, 0) / total if total else 0.9)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)`` for every row; null and wordless texts score as no word at all."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        memo: dict[str, float] = {}
        for batch in batches:
            out = []
            for at in range(0, len(batch), ROWS_PER_BATCH):
                rows = [text_words(t) if t else set() for t in batch.iloc[at:at + ROWS_PER_BATCH]]
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                fresh = list(set().union(*rows).difference(memo))
                memo.update(zip(fresh, word_values(fresh, m.table).tolist()))
                out.append(m.probability([np.array([memo[w] for w in words]) for words in rows]))
            yield pd.Series(np.concatenate(out) if out else [], dtype="float64")

    value = F.pandas_udf(run, "double")
    return docs.select(F.col(id_col), value(F.col(text_col)).alias("score"))


def drop_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is under the threshold, with their columns.

    Null and wordless texts are not toxic by any word and stay.
    """
    scored = score(packed(docs, text=F.col(text_col)), model, "doc", "text")
    wordless = ~F.coalesce(F.col(f"doc.`{text_col}`"), F.lit("")).rlike(r"\S")
    return scored.where((F.col("score") < threshold) | wordless).select("doc.*")
