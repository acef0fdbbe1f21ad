"""SentencePiece encoding and decoding of whole texts.

An Aho-Corasick automaton over the vocabulary's pieces runs once over the
text; at each position its output links give every piece that ends there, and
each relaxes the best score of that position (Viterbi).  Characters that no
piece covers cost the vocabulary's least score minus a fixed penalty and are
written as byte pieces, so every text comes back unchanged.

The vocabulary file is read on the driver by its path (a parameter) and sent
to the tasks, its size being that of the vocabulary.  A task remembers the
pieces of text chunks it has met, up to ``MEMO_CHUNKS``; then it starts anew.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"          # how the pieces write a space
UNKNOWN_PENALTY = 10.0
MEMO_CHUNKS = 400_000
ROWS_PER_BATCH = 512

# piece types of the model file's format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    types: list[int]
    dummy_prefix: bool


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            size = varint()
        yield tag >> 3, data[at:at + size]
        at += size


def read_vocabulary(model: bytes) -> Vocabulary:
    """Pieces, scores and types of a SentencePiece model file's bytes."""
    pieces, scores, types, dummy = [], [], [], True
    for number, value in _fields(model):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece.get(1, b"").decode("utf-8"))
            scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
            types.append(piece.get(3, NORMAL))
        elif number == 3:
            dummy = bool(dict(_fields(value)).get(3, 1))
    return Vocabulary(pieces, scores, types, dummy)


class PieceCoder:
    """Best-scoring segmentation of texts into a vocabulary's pieces, and back."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        self.dummy_prefix = vocabulary.dummy_prefix
        self.automaton = ahocorasick.Automaton()
        self.single: set[str] = set()
        self.byte_ids = [-1] * 256
        self.written: list[bytes] = []
        least = 0.0
        self.crossing = False
        for i, (piece, score, kind) in enumerate(zip(vocabulary.pieces, vocabulary.scores, vocabulary.types)):
            text = b""
            if kind in (NORMAL, USER_DEFINED) and piece:
                self.automaton.add_word(piece, (len(piece), score, i))
                least = min(least, score) if kind == NORMAL else least
                if len(piece) == 1:
                    self.single.add(piece)
                if SPACE in piece.lstrip(SPACE):
                    self.crossing = True      # a piece spans a word end: texts stay whole
                text = piece.replace(SPACE, " ").encode()
            elif kind == BYTE:
                byte = int(piece[3:5], 16)
                self.byte_ids[byte] = i
                text = bytes([byte])
            self.written.append(text)
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary has no byte pieces: texts could not be restored")
        self.automaton.make_automaton()
        self.unknown = least - UNKNOWN_PENALTY
        self.memo = _Memo(self)

    def viterbi(self, chunk: str) -> tuple[list[int], float]:
        """Ids and score of the best path; ties keep the longest last piece."""
        n = len(chunk)
        ends: list[list] = [[] for _ in range(n + 1)]
        for end, match in self.automaton.iter(chunk):
            ends[end + 1].append(match)
        best, back = [0.0] * (n + 1), [(0, 0)] * (n + 1)
        for e in range(1, n + 1):
            top, step = float("-inf"), (1, -1)
            for size, score, piece in ends[e]:      # longest first
                score += best[e - size]
                if score > top:
                    top, step = score, (size, piece)
            if chunk[e - 1] not in self.single and best[e - 1] + self.unknown > top:
                top, step = best[e - 1] + self.unknown, (1, -1)
            best[e], back[e] = top, step
        ids: list[int] = []
        e = n
        while e:
            size, piece = back[e]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.byte_ids[b] for b in reversed(chunk[e - 1].encode()))
            e -= size
        ids.reverse()
        return ids, best[n]

    def chunks(self, text: str) -> list[str | None]:
        """Parts that no piece crosses; None stands for a space sign in the text itself."""
        lead = SPACE if self.dummy_prefix else ""
        plain = SPACE not in text
        if plain and lead and not self.crossing and "  " not in text and not text.startswith(" "):
            return (lead + text.replace(" ", " " + SPACE)).split(" ") if text else []
        out: list[str | None] = []
        for k, part in enumerate(text.split(SPACE)):
            if k:
                out.append(None)
            whole = ("" if k else lead) + part.replace(" ", SPACE)
            if text:
                out.extend([whole] if self.crossing and whole else re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", whole))
        return out

    def encode(self, text: str) -> tuple[np.ndarray, float]:
        chunks = self.chunks(text)
        memo = self.memo
        if len(memo) > MEMO_CHUNKS:
            memo.restart()
        found = list(map(memo.__getitem__, chunks))
        return np.frombuffer(b"".join([ids for ids, _ in found]), dtype=np.int32), float(sum([s for _, s in found]))

    def decode(self, ids: list[int]) -> bytes:
        """The UTF-8 bytes that the ids stand for."""
        text = b"".join(map(self.written.__getitem__, ids))
        return text[1:] if self.dummy_prefix and text.startswith(b" ") else text


class _Memo(dict):
    """Chunk -> (packed ids, score), computed when first asked for."""

    def __init__(self, coder: PieceCoder):
        super().__init__()
        self.coder = coder
        self.restart()

    def restart(self) -> None:
        self.clear()
        literal = [self.coder.byte_ids[b] for b in SPACE.encode()]
        self[None] = (np.array(literal, np.int32).tobytes(), self.coder.unknown)

    def __missing__(self, chunk: str) -> tuple[bytes, float]:
        ids, score = self.coder.viterbi(chunk)
        self[chunk] = out = (np.array(ids, np.int32).tobytes(), score)
        return out


_coders: dict[int, PieceCoder] = {}


def _coder(model: bytes) -> PieceCoder:
    """One coder per Python worker and model."""
    key = hash(model)
    if key not in _coders:
        _coders.clear()
        _coders[key] = PieceCoder(read_vocabulary(model))
    return _coders[key]


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           model_path: str = DEFAULT_MODEL) -> DataFrame:
    """``(id_col, n_tokens, token_ids, score, restored)`` for every row of ``docs``.

    ``token_ids`` segments the whole text; ``score`` is the sum of the pieces'
    scores; ``restored`` tells whether decoding the ids gives the text back byte
    for byte.  An empty text has no ids; a null text has none and a null
    ``restored``.  Repeated rows stay; other columns are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_tokens int, token_ids array<int>, score double, restored boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_BATCH):
                part = batch.slice(at, ROWS_PER_BATCH)
                ids, scores, same = [], [], []
                for text in part.column(1).to_pylist():
                    got, score = coder.encode(text or "")
                    ids.append(got)
                    scores.append(score)
                    same.append(None if text is None else coder.decode(got.tolist()) == text.encode())
                sizes = np.array([len(x) for x in ids], dtype=np.int32)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int32()), lists, pa.array(scores, pa.float64()), pa.array(same, pa.bool_())],
                    names=[id_col, "n_tokens", "token_ids", "score", "restored"])

    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, schema)


def decode(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "token_ids",
           model_path: str = DEFAULT_MODEL) -> DataFrame:
    """``(id_col, text)``: the texts that the ids stand for (null ids: null text)."""
    model = tokens.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    schema = f"`{id_col}` {tokens.schema[id_col].dataType.simpleString()}, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(model.value)
        for batch in batches:
            texts = [None if ids is None else coder.decode(ids).decode("utf-8", "replace") for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return tokens.select(id_col, ids_col).mapInArrow(run, schema)
