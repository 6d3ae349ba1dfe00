"""BPE: ids of the library on whole texts, exact round trip, defined cases."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from scorewatch.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(f.read()), special_tokens={})


def texts(n):
    rnd = random.Random(4)
    parts = ["word", "Wörter", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!?", "'s", "'", "don't", "12", "x9", "日本語", "\u00a0", "🙂",
             " a", "²", "\u2028", "<|endoftext|>", "a.b", "'re9", "\x1c", "ß", "e\u0301"]
    return ["".join(rnd.choices(parts, k=rnd.randrange(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("piece", [1, 5, 40])
def test_pieces_have_the_ids_of_the_whole(library, piece):
    for text in texts(800):
        assert "".join(bpe.safe_pieces(text, piece)) == text
        assert bpe.encode_text(library, text, piece) == library.encode_ordinary(text), repr(text)


def test_round_trip(spark, library):
    rows = list(enumerate(texts(100)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in bpe.decode(bpe.encode(df, PATH, public_tokenizers.PATTERN, piece=10), PATH, public_tokenizers.PATTERN).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(rows[r.doc_id][1])
        assert bytes(r.decoded) == rows[r.doc_id][1].encode()


def test_edge_rows(spark, library):
    rows = [(1, None), (2, ""), (3, "two"), (3, "two"), (None, "x"), (4, "a" * 300_000), (5, "many words " * 50_000)]
    df = spark.createDataFrame([(*r, b"q") for r in rows], "doc_id long, text string, ids binary")
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.round_trip(df, PATH, public_tokenizers.PATTERN).collect())
    want = []
    for d, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((d or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.round_trip(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
