"""Token ids as flat binary files, with 64-bit document offsets.

``write`` deals the documents out in id order, encodes each partition with the
tokenizers library and writes, into a folder that all executors share:

* ``<part>.ids``: the ids of its documents one after the other, as
  little-endian unsigned integers of 16 bits where the vocabulary fits, else
  of 32 bits; each document ends with the end id;
* ``<part>.off``: one 64-bit offset per document and one more, counted from
  the first id of all files.

The offsets need the number of ids before a partition, a prefix sum over one
manifest row per partition. ``read`` maps the files into memory. A file's name
holds the task attempt; the manifest names the files of the attempt that
counted, so a lost executor or a second attempt does no harm.

Defined cases: null and empty texts give the end id alone; rows of equal id
stand in order of their text's hash; null ids come first; special tokens in a text
have their own ids, as the library gives them; very long texts are cut into units
like others; an empty table gives an empty result; other columns, whatever their
names, are not read.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import checkpointed, shared_folder, slices, store, texts, utf8
from .wordhash import byte_class

TOGETHER = 200  # words in one call; the library slows down on longer texts
_encoders: dict[int, CachedEncoder] = {}

_WHITE = byte_class((0x09, 0x0D), (0x1C, 0x20))
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
_MARK = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
#: Last two bytes of the white space beyond ASCII, in UTF-8.
_WIDE_WHITE = np.zeros(1 << 16, bool)
_WIDE_WHITE[[0xC285, 0xC2A0, 0x9A80, 0x80A8, 0x80A9, 0x80AF, 0x819F, *range(0x8080, 0x808B)]] = True
_WORD = re.compile(rb" [^\s\x1c-\x1f]+\Z")  # bytes from 0x80 on included, so wide white space is looked for too
_WIDE = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def units(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the rows' texts can be cut so that the ids of a text are those of
    its parts: at places that no match of the byte-level pattern goes across.

    * before white space, after a character that isn't white space;
    * after a single line feed between two that aren't;
    * between a letter and an ASCII mark.

    Where bytes beyond ASCII leave a doubt there is no cut. A text without any
    such place, however long, is one unit."""
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        white = _WHITE[raw]
        solid = ~white
        pairs = (raw[:-1].astype(np.uint16) << 8) | raw[1:]
        solid[1:] &= ~_WIDE_WHITE[pairs] | (raw[1:] < 0x80)  # may be taken for wide white space: no cut
        letter = _LETTER[raw]
        letter[1:] |= (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)
        cut[1:n] = white[1:] & solid[:-1]
        cut[1:n] |= letter[:-1] & _MARK[raw[1:]]
        plain = (raw < 0x80) & ~white | (raw == 0xC3)
        cut[2:n] |= solid[:-2] & (raw[1:-1] == 0x0A) & plain[2:]
    cut[offsets] = True
    return cut


class CachedEncoder:
    """The library's ids of texts, as it is set up by default (special tokens
    in a text are special).

    A slice of texts is cut into units (``units``), words mostly. Arrow numbers
    the distinct ones, so a word is handled once a slice; their ids are kept
    for the next slices, up to ``keep`` units. Unknown words go to the library
    many at a time. Ids are put together by numpy. A text that holds a special
    token is one unit.
    """

    def __init__(self, raw: str, keep: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(raw)
        size = self.library.get_vocab_size()
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        # Each character of a byte-level token stands for one byte.
        self.width = np.array([len(self.library.id_to_token(i) or "") for i in range(size)], np.int64)
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.keep = keep
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = [np.zeros(0, self.dtype)]  # ids of the known units, one after the other
        self.sizes: list[np.ndarray] = [np.zeros(0, np.int64)]

    def _add(self, new: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.ids.append(ids)
        self.sizes.append(sizes)

    def _learn(self, new: list[bytes]) -> None:
        words, other = [], []
        for x in new:
            (words if _WORD.match(x) and (x.isascii() or not _WIDE.search(x.decode("utf-8", "replace"))) else other).append(x)
        for i in range(0, len(words), TOGETHER):
            part = words[i: i + TOGETHER]
            ids = self._encoded([b"".join(part)])[0]
            ends = np.cumsum([len(x) for x in part])
            at = np.searchsorted(np.cumsum(self.width[ids]), ends, "right")
            self._add(part, ids, np.diff(at, prepend=0))
        for i in range(0, len(other), TOGETHER):
            part = other[i: i + TOGETHER]
            ids = self._encoded(part)
            self._add(part, np.concatenate(ids), np.array([len(x) for x in ids], np.int64))

    def _encoded(self, texts: list[bytes]) -> list[np.ndarray]:
        made = self.library.encode_batch_fast([x.decode("utf-8", "replace") for x in texts], add_special_tokens=False)
        return [np.array(x.ids, self.dtype) for x in made]

    def encode_column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, one after the other, and the number of each row's."""
        raw, offsets = utf8(column)
        cut = units(raw, offsets)
        whole = raw.tobytes()
        for token in self.special:
            at = whole.find(token)
            while at >= 0:
                row = np.searchsorted(offsets, at, "right") - 1
                cut[offsets[row] + 1: offsets[row + 1]] = False
                at = whole.find(token, int(offsets[row + 1]))
        places = np.flatnonzero(cut)
        if len(places) < 2:
            return np.zeros(0, self.dtype), np.zeros(len(column), np.int64)
        parts = pa.Array.from_buffers(pa.large_binary(), len(places) - 1,
                                      [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(whole)]).dictionary_encode()
        distinct = parts.dictionary.to_pylist()
        if len(self.known) > self.keep:
            self._forget()
        self._learn([x for x in distinct if x not in self.known])
        if len(self.ids) > 1:
            self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        begins = np.cumsum(self.sizes[0]) - self.sizes[0]
        own = number[parts.indices.to_numpy()]
        size = self.sizes[0][own]
        ends = np.cumsum(size)
        ids = self.ids[0][np.repeat(begins[own] - (ends - size), size) + np.arange(int(ends[-1]))]
        before = np.concatenate([[0], ends])[np.searchsorted(places, offsets)]
        return ids, np.diff(before)

    def encode(self, batch: list[str]) -> list[bytes]:
        ids, counts = self.encode_column(pa.array(batch, pa.large_string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])]


def _encoder(raw: str) -> CachedEncoder:
    """One per worker process, so that its pieces serve the next task too."""
    if hash(raw) not in _encoders:
        _encoders[hash(raw)] = CachedEncoder(raw)
    return _encoders[hash(raw)]


def _mapped(files: fs.FileSystem, path: str, dtype) -> np.ndarray:
    """The file in mapped memory: in place where it is a local file, else
    through a copy in the task's own temporary folder, gone when unmapped."""
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with files.open_input_stream(path) as source, tempfile.TemporaryFile() as copy:
        while block := source.read(8 << 20):
            copy.write(block)
        copy.flush()
        return np.memmap(copy, dtype, "r") if copy.tell() else np.zeros(0, dtype)


def write(docs: DataFrame, tokenizer_path: str, folder: str, end_id: int = 0, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Write the files; one manifest row per partition: part, file (its stem),
    dtype, n_docs, n_ids and base (ids in all partitions before it)."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        raw = spark.sparkContext.broadcast(f.read())
    files, root = store(folder)
    files.create_dir(root, recursive=True)

    def run(batches):
        part = TaskContext.get().partitionId()
        files, root = store(folder)
        stem, encoder = f"{part:06d}-{uuid.uuid4().hex[:12]}", _encoder(raw.value)
        ids, counts = [], [np.zeros(0, np.int64)]
        with files.open_output_stream(f"{root}/{stem}.ids") as out:
            for piece in slices(batches):
                made, sizes = encoder.encode_column(piece.column("text"))
                out.write(np.insert(made, np.cumsum(sizes), end_id).tobytes())
                counts.append(sizes + 1)
                ids.extend(piece.column("doc_id").to_pylist())
        counts = np.concatenate(counts)
        with files.open_output_stream(f"{root}/{stem}.doc") as out, pa.ipc.new_file(out, pa.schema([("doc_id", kind)])) as table:
            table.write_batch(pa.record_batch([pa.array(ids, kind)], ["doc_id"]))
        with files.open_output_stream(f"{root}/{stem}.len") as out:
            out.write(counts.astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"part": [part], "file": [stem], "dtype": [encoder.dtype.str],
                                          "n_docs": [len(ids)], "n_ids": [int(counts.sum())]})

    source = texts(docs, id_col, text_col).withColumn("_order", F.xxhash64("text")).withColumn(
        "_row", F.monotonically_increasing_id())
    kind = to_arrow_type(source.schema["doc_id"].dataType)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = source.repartitionByRange(parts, "doc_id", "_order", "_row").sortWithinPartitions("doc_id", "_order", "_row")
    manifest = checkpointed(ordered.select("doc_id", "text").mapInArrow(
        run, "part long, file string, dtype string, n_docs long, n_ids long"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    manifest = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return checkpointed(_finish(manifest, folder, parts))


def _finish(manifest: DataFrame, folder: str, parts: int) -> DataFrame:
    """Turn each partition's lengths into offsets from the first id of all."""

    def run(batches):
        files, root = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                lengths = _mapped(files, f"{root}/{row['file']}.len", "<i8")
                offsets = np.concatenate([[0], np.cumsum(lengths)]) + row["base"]
                stem = f"{row['file']}-{uuid.uuid4().hex[:8]}"
                with files.open_output_stream(f"{root}/{stem}.off") as out:
                    out.write(offsets.astype("<i8").tobytes())
                yield pa.RecordBatch.from_pylist([row | {"offsets": stem}])

    return manifest.repartitionByRange(parts, "part").mapInArrow(
        run, "part long, file string, dtype string, n_docs long, n_ids long, base long, offsets string")


def read(manifest: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """Every document of the files: doc_id, start (ids before it), n_tokens and
    the unsigned crc32 of its ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        files, root = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if not row["n_docs"]:
                    continue
                ids = _mapped(files, f"{root}/{row['file']}.ids", row["dtype"])
                offsets = _mapped(files, f"{root}/{row['offsets']}.off", "<i8")
                with files.open_input_file(f"{root}/{row['file']}.doc") as source:
                    keys = pa.ipc.open_file(source).read_all().column("doc_id").combine_chunks()
                for i in range(0, row["n_docs"], 10_000):
                    at = offsets[i: i + 10_001] - row["base"]
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(at[:-1], at[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(i, 10_000), pa.array(at[:-1] + row["base"], pa.int64()),
                         pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return manifest.mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long")


def written_and_read(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    return read(write(docs, tokenizer_path, folder, end_id), folder, dict(docs.dtypes)["doc_id"])
