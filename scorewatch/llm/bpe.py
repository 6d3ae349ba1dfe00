"""Byte-level BPE encoding and decoding with the tiktoken library.

``encode`` adds the ids of every whole text, ``decode`` turns ids back into
the raw bytes. Long texts go to the library piece by piece, cut only where no
match of the pre-splitting pattern can span the cut, so the ids are those of
the whole text. A text without such a place, however long, is one piece.

Defined cases: null and empty texts give no ids and decode to no bytes;
repeated rows are encoded each; an empty table gives an empty table; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts

#: No alternative of the pattern goes on from a letter or digit into a space or
#: line feed, from a letter into a digit or back, or from either into a mark.
_SAFE = regex.compile(r"(?<=[\p{L}\p{N}])(?=[ \n])|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})"
                      r"|(?<=[\p{L}\p{N}])(?=[!-/:-@\[-`{-~])")
_encodings: dict[tuple[int, int], object] = {}


def load_ranks(raw: bytes) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: base64 token and rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x.strip())}


def safe_pieces(text: str, size: int) -> Iterator[str]:
    """Pieces of at least ``size`` characters that end at the next safe border."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start: cut.start()]
        start = cut.start()
    yield text[start:]


def _encoding(raw: bytes, pattern: str):
    import tiktoken

    key = (hash(raw), hash(pattern))
    if key not in _encodings:
        _encodings[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=load_ranks(raw), special_tokens={})
    return _encodings[key]


def encode_text(encoding, text: str, piece: int) -> list[int]:
    if len(text) <= piece:
        return encoding.encode_ordinary(text)
    return list(itertools.chain.from_iterable(encoding.encode_ordinary(x) for x in safe_pieces(text, piece)))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           piece: int = 1 << 16) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers). The rank file is
    read by the driver and broadcast; its size is that of the vocabulary."""
    with open(ranks_path, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encoding = _encoding(ranks.value, pattern)
        for part in slices(batches):
            ids = [np.array(encode_text(encoding, t, piece), "<u4").tobytes() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    source = texts(docs, id_col, text_col)
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids, and ``decoded``: the raw bytes that the ids stand for."""
    with open(ranks_path, "rb") as f:
        ranks = tokens.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        encoding = _encoding(ranks.value, pattern)
        for part in slices(batches, "ids", 4 << 20):
            raw = [encoding.decode_bytes(np.frombuffer(x, "<u4").tolist()) for x in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(raw, pa.binary())],
                                             ["doc_id", "ids", "decoded"])

    source = tokens.select("doc_id", "ids")
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digest of the ids, digest of the bytes
    that they decode to."""
    both = decode(encode(docs, ranks_path, pattern), ranks_path, pattern)
    return both.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
