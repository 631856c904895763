"""Token ids of documents in binary files that can be read one document at a time.

A file is a row of independent zstandard frames, each holding the ids of a few
documents as little-endian unsigned 32-bit integers. Two skippable frames
follow: an index of the documents, and the seek table of the seekable
zstandard format with the sizes and the checksum of every frame. Any
zstandard reader can decompress a file; a reader that knows the seek table
fetches the frames of the wanted documents alone.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, pick, worker_state
from tidemark.llm.units import UnitTable, runs

END_ID = 0
FRAME_BYTES = 1 << 18
LEVEL = 1
TEXT_BYTES = 4 << 20

# Fixed values of the seekable zstandard format, and of the index frame here.
SEEK_FRAME = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80
INDEX_FRAME = 0x184D2A5D

_INDEX = np.dtype([("doc_id", "<i8"), ("missing", "<i8"), ("start", "<i8"), ("length", "<i8")])
# Where splitting at single spaces would change what the pre-tokenizer sees.
_UNSAFE = re.compile(r"\s\s\s|\s\s\Z")


# Words in Latin letters with marks after them, also with one line break inside: pre-tokens that are plain to see.
_LATIN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_MARKS = ".,;:!?"
_PLAIN = re.compile(rf"([{_LATIN}]+)([{_MARKS}]*)(?:(\n)([{_LATIN}]+)([{_MARKS}]*))?")


class ByteBpe:
    """Encodes by a byte-level BPE file of the tokenizers library; ids come as little-endian 32-bit bytes.

    The pre-tokenizer starts a token at a space between other characters, so
    ``" " + word`` encodes alike everywhere and is remembered. A text with
    longer runs of white space, or with the text of an added token, is
    encoded whole. Words whose pre-tokens are plain to see go to the model of
    the tokenizer directly, all others through the whole of it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self._model = self.tokenizer.model
        self._added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._space, self._letters = self._spelled(" "), UnitTable(self._spelled)
        self._marks = UnitTable(lambda text: self._ids(self._spelled(text)))
        self._inner, self._leading = UnitTable(self.unit), UnitTable(lambda text: self.unit(text, ""))

    def _spelled(self, text: str) -> str:
        return self._as_bytes.pre_tokenize_str(text)[0][0]

    def _ids(self, spelling: str) -> bytes:
        ids = [t.id for t in self._model.tokenize(spelling)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, text: str) -> bytes:
        if text.isascii():
            return self._ids(text.replace(" ", self._space))
        return self._ids("".join(map(self._letters.__getitem__, text)))

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def unit(self, text: str, lead: str = " ") -> bytes:
        """Ids of a text between two spaces, with the first of them unless ``lead`` is empty."""
        core = text.rstrip(_MARKS)
        if core.isascii() and core.isalpha():
            ids = self._ids(self._space + core if lead else core)
            return ids + self._marks[text[len(core) :]] if len(core) < len(text) else ids
        plain = _PLAIN.fullmatch(text)
        if not plain:
            return self.whole(lead + text)
        first, after, line, second, end = plain.groups()
        ids = self._word(lead + first)
        if after:
            ids += self._marks[after]
        if line:
            ids += self._marks[line] + self._word(second) + (self._marks[end] if end else b"")
        return ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        inner, leading, found = self._inner.__getitem__, self._leading, []
        for text in texts:
            if _UNSAFE.search(text) or any(a in text for a in self._added):
                found.append(self.whole(text))
            else:
                first, *others = text.split(" ")
                found.append(leading[first] + b"".join(map(inner, others)))
        return found


def place(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that it has for Spark."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()


def write_file(uri: str, documents: Iterable[tuple[int | None, bytes]]) -> tuple[int, int]:
    """Write (doc_id, id bytes) in order; returns the numbers of documents and ids.

    The file appears under its name only when it is complete, so a task that
    is lost or runs twice leaves nothing half written.
    """
    system, path = place(uri)
    system.create_dir(os.path.dirname(path))
    task = TaskContext.get()
    draft = f"{path}.{task.taskAttemptId() if task else 0}.draft"
    compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
    index, table, held, size, start = [], [], [], 0, 0
    with system.open_output_stream(draft) as out:

        def flush(data: bytes) -> None:
            packed = compressor.compress(data)
            out.write(packed)
            table.append(struct.pack("<III", len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

        for doc_id, data in documents:
            index.append((doc_id or 0, doc_id is None, start, len(data) // 4))
            start += len(data) // 4
            held.append(data)
            size += len(data)
            if size >= FRAME_BYTES:
                whole = b"".join(held)
                # A document longer than a frame goes on in the next ones.
                for at in range(0, size, FRAME_BYTES):
                    flush(whole[at : at + FRAME_BYTES])
                held, size = [], 0
        if held:
            flush(b"".join(held))
        packed_index = compressor.compress(np.array(index, _INDEX).tobytes())
        out.write(struct.pack("<II", INDEX_FRAME, len(packed_index)) + packed_index)
        footer = struct.pack("<IBI", len(table), CHECKSUM_FLAG, SEEK_MAGIC)
        out.write(struct.pack("<II", SEEK_FRAME, 12 * len(table) + 9) + b"".join(table) + footer)
    system.move(draft, path)
    return len(index), start


class TokenFile:
    """Reads documents of one file; decompresses only the frames that hold them, and checks those."""

    def __init__(self, uri: str):
        system, path = place(uri)
        self._file = system.open_input_file(path)
        size = self._file.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError(f"no seek table with checksums at the end of {uri}")
        table = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), "<u4").reshape(frames, 3)
        self._checks = table[:, 2]
        self._packed = np.concatenate([[0], np.cumsum(table[:, 0], dtype=np.int64)])
        self._plain = np.concatenate([[0], np.cumsum(table[:, 1], dtype=np.int64)])
        kind, length = struct.unpack("<II", self._at(int(self._packed[-1]), 8))
        if kind != INDEX_FRAME:
            raise ValueError(f"no index of documents in {uri}")
        self._unpack = zstandard.ZstdDecompressor()
        packed_index = self._at(int(self._packed[-1]) + 8, length)
        self.index = np.frombuffer(self._unpack.decompress(packed_index), _INDEX)
        self._last: tuple[int, bytes] = (-1, b"")
        self.frames_read = 0

    def _at(self, start: int, size: int) -> bytes:
        self._file.seek(start)
        return self._file.read(size)

    def _frame(self, k: int) -> bytes:
        if self._last[0] != k:
            packed = self._at(int(self._packed[k]), int(self._packed[k + 1] - self._packed[k]))
            data = self._unpack.decompress(packed)
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self._checks[k]:
                raise ValueError(f"frame {k} does not match its checksum")
            self._last = (k, data)
            self.frames_read += 1
        return self._last[1]

    def entry(self, row: int) -> tuple[int | None, int, bytes]:
        """(doc_id, first position in the file, id bytes) of the document in row ``row`` of the index."""
        doc_id, missing, start, length = self.index[row].tolist()
        low, high = 4 * start, 4 * (start + length)
        parts = []
        k = int(np.searchsorted(self._plain, low, "right")) - 1
        while low < high:
            base, until = int(self._plain[k]), min(high, int(self._plain[k + 1]))
            parts.append(self._frame(k)[low - base : until - base])
            low, k = until, k + 1
        return None if missing else doc_id, start, b"".join(parts)

    def ids(self, doc_id: int) -> list[np.ndarray]:
        """Ids of every document with this id."""
        rows = np.nonzero((self.index["doc_id"] == doc_id) & (self.index["missing"] == 0))[0]
        return [np.frombuffer(self.entry(int(r))[2], "<u4") for r in rows]

    def __enter__(self) -> TokenFile:
        return self

    def __exit__(self, *_) -> None:
        self._file.close()


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Encode every text, append ``end_id``, and write the ids in ascending doc_id order.

    Returns the manifest: (file, path, documents, ids, start), one row per
    file; ``start`` counts the ids in the files before. Rows are dealt by
    ranges of (doc_id, hash of the text), so many rows with one id are spread
    as well; repeated rows are all written, rows without doc_id come first,
    NULL texts count as empty. ``folder`` must be reachable from all
    executors through a file system that pyarrow knows.
    """
    spark = docs.sparkSession
    folder = qualified(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        encode = worker_state(f"byte_bpe:{tokenizer}", lambda: ByteBpe(tokenizer))
        end = np.array([end_id], "<u4").tobytes()

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                rows = [(i, t or "") for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
                for held in runs(rows, lambda r: len(r[1]), TEXT_BYTES):
                    for (i, _), data in zip(held, encode([t for _, t in held]), strict=True):
                        yield i, data + end

        path = f"{folder}/ids-{part:06d}.zst"
        count, ids = write_file(path, documents())
        yield pa.RecordBatch.from_pylist([{"file": part, "path": path, "documents": count, "ids": ids}])

    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    files = ordered.mapInArrow(run, "file long, path string, documents long, ids long")
    scratch = Scratch(spark, "token-files")
    files = scratch.keep(files, "manifest")
    # One row per file: bounded by the number of partitions.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Every document of the files: (doc_id, start, ids as bytes); ``start`` counts all ids before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with TokenFile(path) as file:
                    entries = (file.entry(r) for r in range(len(file.index)))
                    for held in runs(entries, lambda e: len(e[2]), TEXT_BYTES):
                        yield pa.RecordBatch.from_pylist(
                            [{"doc_id": i, "start": base + s, "ids": data} for i, s, data in held], schema
                        )

    files = max(1, manifest.count())
    spread = manifest.select("path", "start").repartitionByRange(files, "path")
    return spread.mapInArrow(run, "doc_id long, start long, ids binary")


def digests(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of documents read back."""
    return tokens.select(
        "doc_id", "start", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )

