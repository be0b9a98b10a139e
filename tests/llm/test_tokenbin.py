import random
import zlib

import numpy as np
import pytest

from panelmart.llm import tokenbin as T
from panelmart.llm.common import scratch_path
from panelmart.llm.queries import tokenizer_file


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 1000, 5000])
def test_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 2**63, n, dtype=np.uint64) >> rng.integers(0, 64, n).astype(np.uint64)
    if n > 2:
        ids[1] = 2**64 - 1  # escape
        ids[2] = 2**60
    assert (T.unpack(T.pack(ids)) == ids).all() and len(T.unpack(T.pack(ids))) == n


def test_packing_is_dense():
    small = T.pack(np.ones(60 * 256, dtype=np.uint64))
    # 256 ones take five words: four of 60 and one for the rest of the block
    assert len(small) == 16 + 4 * 60 + 8 * 5 * 60
    ids = np.random.default_rng(0).integers(0, 50_257, 100_000)
    assert len(T.pack(ids)) < 2.7 * len(ids)


def test_blocks_stand_alone():
    ids = np.random.default_rng(1).integers(0, 2**20, 3 * T.BLOCK, dtype=np.uint64)
    segment = T.pack(ids)
    offsets = np.frombuffer(segment, dtype="<u4", count=3, offset=16)
    words = segment[16 + 12:]
    alone = T.pack(ids[T.BLOCK:2 * T.BLOCK])
    assert words[8 * offsets[1]:8 * offsets[2]] == alone[16 + 4:]


def test_encoder_matches_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file(T.TOKENIZER))
    encode = T.Encoder(tokenizer_file(T.TOKENIZER))
    rng = random.Random(4)
    bits = ["a", "the", " ", "  ", "\n", "\n\n", "\t", "'s", " b", "é", "1", "234", "!", "?.", "中", "😀", "<|endoftext|>", "\xa0", "'", "\r\n", "_",
            "\x1c", "\x85", "　", "x y", "don't", "THE!!", "&&&"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 10)))
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def brute(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file(T.TOKENIZER))
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def digest(spark, docs, **options):
    path = scratch_path(spark, "tokens")
    T.write_tokens(docs, path, tokenizer_file(T.TOKENIZER), **options)
    return path, sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in T.read_digests(spark, path).collect()), key=lambda r: r[1])


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    path, got = digest(spark, docs, files=5, segment_ids=3000)
    assert got == want
    segments = spark.read.parquet(path)
    assert segments.count() > 5
    # files are in ascending order of doc_id
    spans = sorted((r.file, r.place, r.doc_ids[0], r.doc_ids[-1]) for r in segments.collect())
    assert all(a[3] < b[2] for a, b in zip(spans, spans[1:]))
    tokens = {r.doc_id: r.tokens for r in T.read_tokens(spark, path).collect()}
    assert all(zlib.crc32(np.array(tokens[i], dtype="<u4").tobytes()) == crc for i, _, _, crc in want)


def test_odd_rows(spark, odd_docs):
    want = brute([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert digest(spark, odd_docs)[1] == want
    assert digest(spark, odd_docs.limit(0))[1] == []


def test_missed_pre_tokens_cost_one_model_call():
    """A part the memo holds, or has held in the generation before, is not encoded again."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file(T.TOKENIZER))
    memo, asked = T.PreTokens(library.model, 4), []
    model = memo.tokenize
    memo.tokenize = lambda part: asked.append(part) or model(part)
    parts = [" the", "the", " été", "\n\n", " the", " a", "'s", "--", " the", " a"]
    got = [memo[p] for p in parts]
    assert got == [np.array(library.encode(p, add_special_tokens=False).ids, dtype="<u4").tobytes() for p in parts]
    assert len(asked) == len(set(parts)) and len(memo) <= 4 and len(memo.old) <= 4


def test_segment_bytes_are_fixed():
    """The format as written before: mixed widths, escapes, a short last block."""
    rng = np.random.default_rng(8)
    ids = rng.integers(0, 2**63, 1500, dtype=np.uint64) >> rng.integers(0, 64, 1500).astype(np.uint64)
    ids[::7] = 2**64 - 1
    assert zlib.crc32(T.pack(ids)) == 1644854478


def test_files_are_written_and_read_in_small_groups(spark, docs_of):
    """A file's writer and readers hold a few segments, however many the file has."""
    from pathlib import Path

    import pyarrow.parquet as pq

    rng = random.Random(11)
    vocabulary = [f" {a}{b}" for a in ("the", "of", "and", "house", "river", "stone") for b in range(400)]
    texts = ["".join(rng.choices(vocabulary, k=30_000)) for _ in range(80)]
    path, got = digest(spark, docs_of(texts), files=1)
    assert got == brute(list(enumerate(texts)))
    files = [pq.ParquetFile(f).metadata for f in Path(path.removeprefix("file:")).glob("*.parquet")]
    groups = [m.row_group(i) for m in files for i in range(m.num_row_groups)]
    assert sum(g.num_rows for g in groups) >= 8  # segments, more than a group's bytes in all
    assert sum(g.total_byte_size for g in groups) > 2 * (4 << 20)
    assert all(g.total_byte_size < 6 << 20 for g in groups)
