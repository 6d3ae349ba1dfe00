"""Token files: exact against the library, file format, defined cases."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from scorewatch.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)  # with its default settings


def texts(n):
    rnd = random.Random(2)
    parts = ["word", "Wörter", " ", "  ", "\n", "\n\n", "\t", ".", ",", "!?", "'s", "don't", "12", "x9", "日本語", "\u00a0", "🙂",
             " a", "the end.\nThen", "²", "\u2028", "<|endoftext|>", "a.b", "foo'", "_x_", "é", "É.", "×", "÷,", "…", "\u3000", "\u200a ",
             "\x85", "\x1f", "\r\n", "'ll", "('s", "ß\n", "\né", "\n ", " \n", "Я", "d'été", "̈"]
    return ["".join(rnd.choices(parts, k=rnd.randrange(0, 40))) for _ in range(n)] + ["<|endoftext|>", "x <|endoftext|>\ny", " ", "  ", "", " a", "a ", "\n "]


def test_cached_encoder_is_the_library(library):
    encoder = token_files.CachedEncoder(open(PATH).read(), keep=50)
    rows = texts(1500)
    for i in range(0, len(rows), 100):
        for text, raw in zip(rows[i: i + 100], encoder.encode(rows[i: i + 100])):
            assert np.frombuffer(raw, encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def expected(rows, library):
    out, start = [], 0
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        out.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_written_and_read(spark, library):
    rows = [(3 * d, t) for d, t in enumerate(texts(200))]
    shuffled = random.Random(1).sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, token_files.written_and_read(spark, df, PATH).collect()))
    assert got == expected(rows, library)


def test_file_format(spark, library, tmp):
    rows = [(d, t) for d, t in enumerate(texts(60))]
    manifest = token_files.write(spark.createDataFrame(rows, "doc_id long, text string"), PATH, tmp).orderBy("part").collect()
    ids = [x for _, t in rows for x in library.encode(t, add_special_tokens=False).ids + [0]]
    starts = [e[1] for e in expected(rows, library)]
    assert [x for m in manifest for x in np.fromfile(f"{tmp}/{m.file}.ids", "<u2").tolist()] == ids
    assert [x for m in manifest for x in np.fromfile(f"{tmp}/{m.offsets}.off", "<i8").tolist()[:-1]] == starts


def test_edge_rows(spark, library):
    rows = [(None, "first"), (1, None), (2, ""), (5, "same"), (5, "same"), (9, "long text " * 30_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, start string")
    got = sorted(map(tuple, token_files.written_and_read(spark, df, PATH).collect()), key=lambda r: r[1])
    assert got == expected(rows, library)
    assert token_files.written_and_read(spark, df.limit(0), PATH).count() == 0
