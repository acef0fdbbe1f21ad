import random
import struct

import pytest
import sentencepiece

from tessera.llm import pieces, queries

with open(pieces.DEFAULT_MODEL, "rb") as f:
    MODEL = f.read()


@pytest.fixture(scope="module")
def coder():
    return pieces.PieceCoder(pieces.read_vocabulary(MODEL))


def test_vocabulary_is_the_model_files(coder):
    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    v = pieces.read_vocabulary(MODEL)
    assert v.pieces == [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
    assert v.scores == [lib.get_score(i) for i in range(lib.get_piece_size())]


def brute_best(coder, scores, chunk):
    """Best score over all segmentations, by recursion over every prefix."""
    memo = {"": 0.0}

    def best(s):
        if s not in memo:
            options = [scores[s[:n]] + best(s[n:]) for n in range(1, len(s) + 1) if s[:n] in scores]
            if s[0] not in scores:
                options.append(coder.unknown + best(s[1:]))
            memo[s] = max(options)
        return memo[s]

    return best(chunk)


def test_viterbi_against_all_segmentations(coder):
    v = pieces.read_vocabulary(MODEL)
    scores = {p: s for p, s, t in zip(v.pieces, v.scores, v.types) if t == pieces.NORMAL}
    rng = random.Random(1)
    words = ["the", "identity", "unbelievable", "größe", "日本語", "x☃y", "\n\n", "aaaa", "tion", "   "]
    words += ["".join(rng.choice("abcdeinorst éß\n") for _ in range(rng.randrange(1, 18))) for _ in range(300)]
    for w in words:
        chunk = "▁" + w.replace(" ", "▁")
        ids, score = coder.viterbi(chunk)
        assert score == brute_best(coder, scores, chunk)
        # chunks are independent: the parts add up to the whole
        assert coder.encode(w)[1] == score


TEXTS = ["", " ", "a", "  a  b ", "a▁b ▁ c", "▁", "é😀 漢字", "\n\t\r\x00 x", "word " * 30000, None, "a", "a"]


def test_round_trip(spark):
    df = spark.createDataFrame([(i % 10, t, "p", 0) for i, t in enumerate(TEXTS)], "doc_id long, text string, token_ids string, n_tokens int")
    out = pieces.encode(df)
    rows = out.collect()
    assert len(rows) == len(TEXTS)
    assert sorted(str(r.restored) for r in rows) == sorted("None" if t is None else "True" for t in TEXTS)
    assert all(r.n_tokens == len(r.token_ids) for r in rows)
    back = pieces.decode(out.where("restored is not null")).collect()
    assert sorted(r.text for r in back) == sorted(t for t in TEXTS if t is not None)
    assert pieces.encode(df.limit(0)).count() == 0


def test_query_restores_every_text(spark):
    rows = queries.op4_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.restored for r in rows)


def test_a_vocabulary_without_bytes_is_refused():
    piece = b"\x0a\x01a" + b"\x15" + struct.pack("<f", -1.0)
    with pytest.raises(ValueError):
        pieces.PieceCoder(pieces.read_vocabulary(b"\x0a" + bytes([len(piece)]) + piece))
