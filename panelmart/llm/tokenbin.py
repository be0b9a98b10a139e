"""Token-id files with Simple-8b word-aligned coding.

Texts are encoded with the ``tokenizers`` library (byte-level BPE) and their
ids packed into 64-bit words: a 4-bit selector says how many ids of how many
bits share the other 60 bits.  A selector of its own is the escape: the next
word holds one id too large for 60 bits as it is.  Ids are coded in blocks of
``BLOCK`` ids, and a segment stores the word offset of every block, so all
blocks of a segment are coded and decoded together with array operations
and any block can be read alone.

Files: rows in ascending ``doc_id`` order, range-partitioned into one folder of
Parquet part files written by Spark (atomic commit, any store, lost tasks rerun).
Each row is one segment: its file and place, the ids before it in the file, the
documents it holds (ids and token counts) and one binary in the format below; a row group
holds a few segments, so that memory does not grow with a file.  Only one total per file is
needed to turn counts inside a file into offsets in the whole sequence.

Segment: ``S8B1`` | number of ids (u64) | number of blocks (u32) | word offset of
each block (u32 each) | words (u64 each); all little-endian.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelmart.llm.common import once_per_worker

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BLOCK = 256                  # ids in a block
SEGMENT_IDS = 1 << 19        # a segment is closed after so many ids (whole documents)
MAX_FILES = 1 << 14          # files of one table; their totals are the only thing broadcast
GROUP_BYTES = 4 << 20        # bytes of a row group, of a few segments
# Rows are segments of about a megabyte.  By default the size of pages and row groups is looked at
# after a hundred rows only, so that writer and readers would hold all the segments of a file at once.
WRITE_OPTIONS = {"parquet.block.size": GROUP_BYTES, "parquet.block.size.row.check.min": 1,
                 "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}
MEMO = 400_000               # pre-tokens of a generation of the workers' memo
# Characters whose class no Unicode version changes: ASCII, Latin letters, common punctuation.
_LATIN = "A-Za-zÀ-ÖØ-öø-ſ"
PLAIN = re.compile(rf"[\n\x20-\x7E{_LATIN}¡§«»¿–—‘’“”„…€]*")
# The pre-token pattern of byte-level BPE, over those characters.
PRE_TOKENS = re.compile(rf" ?[{_LATIN}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\s{_LATIN}0-9]+|\s+(?!\S)|\s+")

# Selector -> (ids in the word, bits of each).  15 is the escape.
SELECTORS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12),
             (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 15
MAGIC = b"S8B1"
FILE_SCHEMA = "file int, place long, before long, doc_ids array<long>, sizes array<long>, n_ids long, segment binary"


# ---------------------------------------------------------------- Simple-8b

_COUNTS = np.array([c for c, _ in SELECTORS] + [0, 1])
_WIDTHS = np.array([w for _, w in SELECTORS] + [0, 0])
_DENSEST = np.array([ESCAPE, *reversed(range(len(SELECTORS)))])  # of so many that fit


def _bit_lengths(ids: np.ndarray) -> np.ndarray:
    top = int(ids.max()).bit_length() if len(ids) else 0
    if top <= 53:  # exact as doubles
        return np.frexp(ids.astype(np.float64))[1].astype(np.int8)
    bits = np.zeros(len(ids), dtype=np.int8)
    for width in range(top):
        bits += ids >= np.uint64(1 << width)
    return bits


def pack(ids: np.ndarray) -> bytes:
    """One segment of the ids (unsigned 64-bit)."""
    ids = np.asarray(ids, dtype=np.uint64)
    n, n_blocks = len(ids), -(-len(ids) // BLOCK)
    # every block is followed by 60 empty places, so that no word looks into the next one
    stride = BLOCK + 60
    flat, bits = np.zeros(n_blocks * stride, dtype=np.uint64), np.zeros(n_blocks * stride, dtype=np.int8)
    for grid, values in ((flat, ids), (bits, _bit_lengths(ids))):
        rows = grid.reshape(n_blocks, stride)
        full = n // BLOCK
        rows[:full, :BLOCK] = values[:full * BLOCK].reshape(full, BLOCK)
        rows[full:, :n - full * BLOCK] = values[full * BLOCK:]
    # at every place: the densest selector whose ids, from there on, are all narrow enough; with
    # one that fits, all sparser ones fit
    fitting, widest, size = np.zeros(len(flat), dtype=np.int8), bits.copy(), 1
    for count, width in reversed(SELECTORS):
        for shift in range(size, count):
            np.maximum(widest[:-shift], bits[shift:], out=widest[:-shift])
        size = count
        fitting += widest <= width
    # places where words begin: all blocks are walked side by side
    step = _COUNTS[_DENSEST]
    begin = np.arange(n_blocks) * stride
    end = begin + np.minimum(BLOCK, n - np.arange(n_blocks) * BLOCK)
    at, walked = begin, []
    while len(at):
        walked.append(at)
        at = at + step[fitting[at]]
        left = at < end
        at, end = at[left], end[left]
    heads = np.sort(np.concatenate(walked)) if walked else begin
    selector = _DENSEST[fitting[heads]]
    count, width = _COUNTS[selector], _WIDTHS[selector].astype(np.uint64)
    word = selector.astype(np.uint64) << np.uint64(60)
    escaped = selector == ESCAPE
    lanes, k = np.flatnonzero(~escaped), 0
    while len(lanes):
        word[lanes] |= flat[heads[lanes] + k] << (width[lanes] * np.uint64(k))
        k += 1
        lanes = lanes[k < count[lanes]]
    ends = np.cumsum(1 + escaped)
    places = ends - 1 - escaped
    words = np.zeros(int(ends[-1]) if n else 0, dtype="<u8")
    words[places] = word
    words[places[escaped] + 1] = flat[heads[escaped]]
    offsets = places[np.searchsorted(heads, begin)]
    return b"".join([MAGIC, struct.pack("<QI", n, n_blocks), offsets.astype("<u4").tobytes(), words.tobytes()])


def unpack(segment: bytes) -> np.ndarray:
    """The ids of a segment; all words are decoded together."""
    if segment[:4] != MAGIC:
        raise ValueError("not a token segment")
    n, n_blocks = struct.unpack_from("<QI", segment, 4)
    offsets = np.frombuffer(segment, dtype="<u4", count=n_blocks, offset=16).astype(np.int64)
    words = np.frombuffer(segment, dtype="<u8", offset=16 + 4 * n_blocks)
    out = np.zeros(n, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    head = np.ones(len(words), dtype=bool)
    for place in np.flatnonzero(selector == ESCAPE).tolist():
        if head[place]:  # the word after an escape is an id
            head[place + 1] = False
    heads = np.flatnonzero(head)
    selector, word = selector[heads], words[heads]
    count, width = _COUNTS[selector], _WIDTHS[selector]
    # a word's first id: its block's, and the ids of the block's words before it
    first = np.searchsorted(heads, offsets)
    block = np.repeat(np.arange(n_blocks), np.diff(np.append(first, len(heads))))
    before = np.cumsum(count) - count
    at = before - before[first][block] + block * BLOCK
    count = np.minimum(count, np.minimum((block + 1) * BLOCK, n) - at)
    escaped = np.flatnonzero(selector == ESCAPE)
    out[at[escaped]] = words[heads[escaped] + 1]
    mask = (np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)
    lanes, k = np.flatnonzero(selector != ESCAPE), 0
    while len(lanes):
        out[at[lanes] + k] = (word[lanes] >> (k * width[lanes]).astype(np.uint64)) & mask[lanes]
        k += 1
        lanes = lanes[k < count[lanes]]
    return out


# ---------------------------------------------------------------- tokenising

# The character that byte-level BPE writes for each byte.
_KEPT = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _KEPT)}


def byte_chars(part: str) -> str:
    """A pre-token as byte-level BPE writes it."""
    if part.isascii() and part.isprintable():  # the blank is the one such character that changes
        return part.replace(" ", _BYTE_CHARS[32])
    return part.encode().decode("latin-1").translate(_BYTE_CHARS)


class PreTokens(dict):
    """Ids (bytes of unsigned 32-bit integers) of pre-tokens; the library's model encodes one when it is first asked for.

    Two generations of at most ``size`` entries: a full one becomes the old one, and what
    is still asked for moves over.
    """

    def __init__(self, model, size: int):
        super().__init__()
        self.tokenize, self.size, self.old = model.tokenize, size, {}

    def __missing__(self, part: str) -> bytes:
        data = self.old.get(part)
        if data is None:
            tokens = self.tokenize(byte_chars(part))
            data = array("I", [t.id for t in tokens]).tobytes()
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[part] = data
        return data


class Encoder:
    """The library's ids of a text, with a memo of frequent pre-tokens.

    Byte-level BPE splits a text into pre-tokens first and never merges across them, so
    each distinct pre-token is encoded once, by the library's model.  Texts with other characters
    than the plain ones, or with the string of an added token (one id, as the library has
    it), go to the library whole; so do all texts where the file names another pre-token
    pattern.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        file = json.loads(self.library.to_str())
        split = file["pre_tokenizer"] or {}
        self.cut = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
                    and not file["normalizer"] and file["model"]["type"] == "BPE")
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.ids = PreTokens(self.library.model, MEMO)

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<u4")
        if not self.cut or not PLAIN.fullmatch(text) or any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.frombuffer(b"".join(map(self.ids.__getitem__, PRE_TOKENS.findall(text))), dtype=np.uint32)


# ---------------------------------------------------------------- files

def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, files: int | None = None, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the token files of a table in ascending ``id_col`` order below ``path``.

    Null text is encoded as empty (the end id alone); null ids come first; rows that
    repeat an id follow each other in order of their text's hash, then text.  An empty table writes no
    segment.  A document is never split over segments; its ids are held whole.
    """
    spark = docs.sparkSession
    files = min(files or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_FILES)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        encode = once_per_worker(f"tokens:{tokenizer_path}", lambda: Encoder(tokenizer_path))
        file, place, before = TaskContext.get().partitionId(), 0, 0
        end = np.array([end_id], dtype="<u4")
        held: list[np.ndarray] = []
        ids: list = []
        sizes: list[int] = []
        total = 0

        def close() -> pa.RecordBatch:
            nonlocal place, before
            flat = np.concatenate(held)
            row = [pa.array([file], pa.int32()), pa.array([place], pa.int64()), pa.array([before], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                   pa.array([sizes], pa.list_(pa.int64())), pa.array([len(flat)], pa.int64()), pa.array([pack(flat)], pa.binary())]
            place += 1
            before += len(flat)
            return pa.RecordBatch.from_arrays(row, ["file", "place", "before", "doc_ids", "sizes", "n_ids", "segment"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = encode(text.as_py())
                held += [own, end]
                ids.append(doc_id)
                sizes.append(len(own) + 1)
                total += sizes[-1]
                if total >= segment_ids:
                    yield close()
                    held, ids, sizes, total = [], [], [], 0
        if held:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # the text's hash is part of the range: rows that repeat an id (or have none) are no single task
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    ordered = rows.repartitionByRange(files, *order[:2]).sortWithinPartitions(*order)
    ordered.mapInArrow(run, FILE_SCHEMA).write.options(**WRITE_OPTIONS).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens and their ids (array of long)."""
    return _read(spark, path, "tokens array<long>",
                 lambda flat, offsets: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.astype(np.int64))))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens and the crc32 of their ids as
    little-endian unsigned 32-bit integers."""
    def crc(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
        data = memoryview(flat.astype("<u4").tobytes())
        cuts = (4 * offsets).tolist()
        return pa.array([zlib.crc32(data[a:b]) for a, b in zip(cuts, cuts[1:])], pa.int64())

    return _read(spark, path, "ids_crc32 long", crc)


def _read(spark: SparkSession, path: str, last: str, digest) -> DataFrame:
    segments = spark.read.schema("file int, place long, before long, doc_ids array<long>, sizes array<long>, n_ids long, segment binary").parquet(path)
    # at most MAX_FILES totals: the running sum over files and the broadcast are bounded
    totals = segments.groupBy("file").agg(F.sum("n_ids").alias("n"))
    starts = totals.select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("file_start"))
    names = ["doc_id", "start", "n_tokens", last.split()[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, sizes, segment, start in zip(*(batch.column(i) for i in range(4))):
                size = np.array(sizes.as_py(), dtype=np.int64)
                offsets = np.concatenate(([0], np.cumsum(size)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids.as_py(), pa.int64()), pa.array(start.as_py() + offsets[:-1]), pa.array(size),
                     digest(unpack(segment.as_py()), offsets)], names)

    whole = segments.join(F.broadcast(starts), "file").select(
        "doc_ids", "sizes", "segment", (F.col("file_start") + F.col("before")).alias("segment_start"))
    return whole.mapInArrow(run, f"doc_id long, start long, n_tokens long, {last}")
