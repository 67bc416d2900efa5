"""Token ids in seekable zstandard files.

A shard is a valid zstandard stream:

* frames: each an independent zstandard frame of whole documents' ids as
  little-endian unsigned integers of ``width`` bytes, about FRAME_IDS ids; a
  longer document has a frame of its own;
* a skippable frame with the document index: a zstandard frame of one int64
  triple (frame, first id within the frame, number of ids) per document,
  then the ids of the documents (null flags and values);
* the seek table of the public seekable format, in a skippable frame: per
  frame compressed size, decompressed size and a checksum (the low 32 bits of
  XXH64 of the decompressed bytes), then frame count, descriptor and magic.

A reader takes the footer, the seek table and the index from the end of the
file, then decompresses only the frames of the documents it wants and checks
each frame's checksum.

Shards are written by the executors into a folder that the cluster shares.
Each attempt at a task writes files of its own names; the manifest lists the
files of the attempts that ended, so a lost executor or a speculative copy
leaves at most unlisted files behind.  A task begins a new shard after
SHARD_DOCS documents or SHARD_IDS ids, so that an index always fits in memory.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import Scratch, small_batches
from ._units import PieceTable, WholeTexts, text_slices

#: Fixed values of the public seekable zstandard format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
HAS_CHECKSUM = 0x80

FRAME_IDS = 1 << 16
#: A shard is closed once it holds so many documents or ids.
SHARD_DOCS, SHARD_IDS = 1 << 20, 1 << 28
LEVEL = 3


def checksum(raw: bytes) -> int:
    return xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF


class ShardWriter:
    """Appends documents to one shard; ``close`` writes index and seek table."""

    def __init__(self, out, width: int):
        self.out, self.width = out, width
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.seek: list[tuple[int, int, int]] = []
        self.index, self.ids, self.null = array("q"), array("q"), array("b")
        self.n_ids = 0

    def __len__(self) -> int:
        return len(self.ids)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.n_waiting and self.n_waiting + len(ids) > FRAME_IDS:
            self.flush()
        self.index.extend((len(self.seek), self.n_waiting, len(ids)))
        self.ids.append(doc_id or 0)
        self.null.append(doc_id is None)
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)

    def flush(self) -> None:
        if not self.waiting:
            return
        raw = np.concatenate(self.waiting).astype(f"<u{self.width}").tobytes()
        frame = self.pack.compress(raw)
        self.out.write(frame)
        self.seek.append((len(frame), len(raw), checksum(raw)))
        self.waiting, self.n_waiting = [], 0

    def close(self) -> None:
        self.flush()
        whole = np.array(self.index, dtype="<i8").tobytes() + self.null.tobytes() + np.array(self.ids, dtype="<i8").tobytes()
        body = struct.pack("<BQ", self.width, len(self)) + self.pack.compress(whole)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(body)) + body)
        table = b"".join(struct.pack("<III", *e) for e in self.seek) + struct.pack("<IBI", len(self.seek), HAS_CHECKSUM, SEEK_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


class ShardReader:
    """Random access to the documents of one shard through a seekable file."""

    def __init__(self, file):
        self.file = file
        file.seek(0, os.SEEK_END)
        end = file.tell()
        n, descriptor, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEK_MAGIC or not descriptor & HAS_CHECKSUM:
            raise ValueError("not a seekable token file")
        seek_at = end - 9 - 12 * n - 8
        table = np.frombuffer(self._at(seek_at + 8, 12 * n), dtype="<u4").reshape(n, 3)
        self.sizes, self.checks = table[:, :2].astype(np.int64), table[:, 2]
        self.starts = np.concatenate(([0], np.cumsum(self.sizes[:, 0])))
        index_at = int(self.starts[-1])
        kind, size = struct.unpack("<II", self._at(index_at, 8))
        if kind != SKIPPABLE_INDEX or index_at + 8 + size != seek_at:
            raise ValueError("the document index does not follow the frames")
        self.width, docs = struct.unpack("<BQ", self._at(index_at + 8, 9))
        raw = zstandard.ZstdDecompressor().decompress(self._at(index_at + 17, size - 9))
        self.index = np.frombuffer(raw, dtype="<i8", count=3 * docs).reshape(docs, 3)
        self.null = np.frombuffer(raw, dtype=np.int8, count=docs, offset=24 * docs).astype(bool)
        self.doc_ids = np.frombuffer(raw, dtype="<i8", offset=25 * docs)
        self.open_frame = (-1, np.zeros(0, np.uint32))

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def frame(self, k: int) -> np.ndarray:
        """Ids of one frame, checked; the last frame read is kept."""
        if self.open_frame[0] != k:
            raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.starts[k]), int(self.sizes[k, 0])), max_output_size=int(self.sizes[k, 1]))
            if len(raw) != self.sizes[k, 1] or checksum(raw) != self.checks[k]:
                raise ValueError(f"frame {k} does not match its checksum")
            self.open_frame = (k, np.frombuffer(raw, dtype=f"<u{self.width}"))
        return self.open_frame[1]

    def document(self, d: int) -> np.ndarray:
        frame, first, n = self.index[d]
        return self.frame(int(frame))[first : first + n] if n else np.zeros(0, np.uint32)

    def __len__(self) -> int:
        return len(self.index)


#: What a file must say for its texts to be cut (fixed values): words, single digits and runs of other signs,
#: with white space dropped and only these normalizers before.
CUTTABLE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CUTTABLE_NORMALIZERS = ("NFC", "Replace", "Lowercase")


def is_cuttable(spec: dict) -> bool:
    """Whether no token of this tokenizers file reaches across the cuts of ``_units.cuts``."""
    normalizers = [n for n in _parts(spec["normalizer"], "normalizers")]
    steps = _parts(spec["pre_tokenizer"], "pretokenizers")
    plain = all(n["type"] in CUTTABLE_NORMALIZERS and n.get("pattern", {"Regex": r"\s+"}) == {"Regex": r"\s+"} and n.get("content", " ") == " " for n in normalizers)
    split = [s for s in steps if s["type"] != "ByteLevel"]
    bytes_only = all(not s["use_regex"] and not s["add_prefix_space"] for s in steps if s["type"] == "ByteLevel")
    one = len(split) == 1 and (split[0]["type"], split[0].get("pattern"), split[0].get("behavior"), split[0].get("invert")) == ("Split", {"Regex": CUTTABLE_SPLIT}, "Removed", True)
    added = all(t["content"].startswith("<|") and not t["lstrip"] and not t["rstrip"] for t in spec["added_tokens"])
    return plain and bytes_only and one and added and spec["model"]["type"] == "BPE"


def _parts(step: dict | None, name: str) -> list[dict]:
    return [] if step is None else step.get(name, [step])


@lru_cache(maxsize=2)
def _library_table(path: str) -> tuple[PieceTable | WholeTexts, int]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    ends_word = np.zeros(tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
    ends_word[[i for t, i in tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def one_by_one(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def many_words(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters only, in one call: each ends with the one token that ends a word."""
        ids = np.array(tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype=np.uint32)
        stop = np.flatnonzero(ends_word[ids]) + 1
        whole = len(stop) == len(words) and stop[-1] == len(ids)
        return (ids, np.diff(stop, prepend=0)) if whole else flat_ids(one_by_one(words))

    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = [p.decode("utf-8") for p in pieces]
        plain = np.fromiter((t.isalpha() for t in texts), dtype=bool, count=len(texts))
        words, rest = ([texts[k] for k in np.flatnonzero(side)] for side in (plain, ~plain))
        done = [many_words(words[s : s + 512]) for s in range(0, len(words), 512)] + [flat_ids(one_by_one(rest))]
        flat, sizes = (np.concatenate([d[k] for d in done]) for k in (0, 1))
        # back from words first to the order of the pieces
        at = np.empty(len(texts), dtype=np.int64)
        at[np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))] = np.arange(len(texts))
        begin, size = (np.cumsum(sizes) - sizes)[at], sizes[at]
        ends = np.concatenate(([0], np.cumsum(size)))
        return flat[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])], size

    size = tokenizer.get_vocab_size(with_added_tokens=True)
    if not is_cuttable(spec):
        return WholeTexts(lambda texts: flat_ids(one_by_one([t.decode("utf-8") for t in texts]))), size
    return PieceTable(encode, keep_spaces=False, lower=any(n["type"] == "Lowercase" for n in _parts(spec["normalizer"], "normalizers"))), size


def flat_ids(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """All ids in one array, and how many each text has."""
    arrays = [np.asarray(p, dtype=np.uint32) for p in parts]
    return np.concatenate(arrays or [np.zeros(0, np.uint32)]), np.array([len(p) for p in parts], dtype=np.int64)


MANIFEST = "shard int, part int, file string, n_docs bigint, n_tokens bigint, width int"


def _write(folder: str, vocabulary: str, end_id: int, most_docs: int, most_ids: int):
    def run(batches):
        table, size = _library_table(vocabulary)
        width = 2 if max(size - 1, end_id) < 1 << 16 else 4
        shard = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        end = np.array([end_id], dtype=np.uint32)
        attempt, part, writer, done = uuid.uuid4().hex, 0, None, []

        def closed() -> tuple:
            writer.close()
            writer.out.close()
            return shard, part, name, len(writer), writer.n_ids, width

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for i, j, data, offsets in text_slices(batch.column(1)):
                ids, at = table.ids(data, offsets)
                for d in range(j - i):
                    if writer is None:
                        store.create_dir(root, recursive=True)
                        name = f"shard-{shard:06d}-{part:04d}-{attempt}.zst"
                        writer = ShardWriter(store.open_output_stream(f"{root}/{name}", compression=None), width)
                    writer.add(doc_ids[i + d], np.concatenate((ids[at[d] : at[d + 1]], end)))
                    if len(writer) >= most_docs or writer.n_ids >= most_ids:
                        done.append(closed())
                        writer, part = None, part + 1
        if writer is not None:
            done.append(closed())
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in done], t) for k, t in enumerate(kinds)], [c.split()[0] for c in MANIFEST.split(", ")])

    return run


def write_token_frames(docs: DataFrame, folder: str, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, shards: int | None = None, shard_docs: int = SHARD_DOCS, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Tokenise whole texts and write shards in ascending order of id; returns the manifest.

    Texts are encoded with the tokenizers library's file ``vocabulary``, no
    special tokens added: distinct words once where its rules allow cutting
    texts into words (see ``is_cuttable``), else whole texts; ``end_id`` ends each document; a null or empty
    text is its end id alone.  Ids ascend from shard to shard and within each,
    null ids first; rows with equal ids are ordered by a hash of the text and
    the text, so a repeated id is spread over shards unless its texts are equal
    too.  No rows make no shard and an empty manifest.  Other columns are
    ignored.  ``folder`` is a URI that pyarrow and Spark both write to.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumn("tie", F.xxhash64("text"))
    n = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    made = dealt.mapInArrow(_write(f"{folder}/frames", vocabulary, end_id, shard_docs, shard_ids), MANIFEST)
    made.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Shards in order with ``start``, the number of ids in all shards before."""
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_shard(folder: str, name: str) -> ShardReader:
    store, root = fs.FileSystem.from_uri(folder)
    return ShardReader(store.open_input_file(f"{root}/frames/{name}"))


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shard = read_shard(folder, name)
                at = start + np.concatenate(([0], np.cumsum(shard.index[:, 2])))
                for a in range(0, len(shard), 512):
                    b = min(a + 512, len(shard))
                    ids = [shard.document(d).astype("<u4").tobytes() for d in range(a, b)]
                    yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids[a:b], mask=shard.null[a:b]), pa.array(at[a:b]), pa.array(shard.index[a:b, 2]), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return run


def read_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    """Every document of the shards: doc_id, start (ids before it), n_tokens, ids (binary, unsigned 32-bit)."""
    small_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = read_manifest(spark, folder).select("file", "start").repartition(n)
    return files.mapInArrow(_read(folder), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def token_folder(spark: SparkSession) -> str:
    """A new folder in the shared place, removed when the driver ends."""
    return Scratch(spark, "tokens").root
