"""SimHash near-dedup with a segment-popcount embedding.

A 64-bit fingerprint is embedded as the bit counts of its 32 two-bit segments.
Each differing bit moves one count by one, so the Manhattan distance of two
embeddings is a lower bound of their Hamming distance.  Counts are held in
unary inside their segment (0: 00, 1: 01, 2: 11), which keeps the whole vector
in one long and makes a Manhattan distance the bit count of an XOR.

Grid range join: the segments form ``GROUPS`` groups.  Two vectors within
distance ``d`` agree on at least ``GROUPS - d`` groups, so both fall into one
grid cell (a choice of that many groups with their counts).  Every distinct
fingerprint goes to all its cells; pairs inside a cell are filtered by
Manhattan distance and verified by Hamming distance.  Only a spanning forest
of each cell's links is emitted, never all pairs; components of the links are
then found by star contraction.

Scale: exact copies collapse to one fingerprint before anything else (map-side
combine); lone cells are dropped by a count; a cell with more than ``BLOCK``
fingerprints is dealt out as pairs of blocks, so no task holds more than two
blocks of one cell and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import scratch
from panelmart.llm.graph import components

SHINGLE, MAX_BITS = 3, 3
GROUPS = 6       # 20 cells a fingerprint at 3 bits; more groups make cells finer
BLOCK = 1024     # fingerprints of a cell in one block
_ODD = 0x5555555555555555


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """64-bit SimHash over the XXH64 (seed 42) of the word shingles, as a signed long."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z, only ASCII white space
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    size = min(width, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[:len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends[size - 1:].tolist())),
                         dtype=np.uint64, count=len(starts))
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for texts of any length
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(``id_col``, text_key, fp) of every row."""
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, text_key long, fp long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(2)), dtype=np.int64, count=len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], [id_col, "text_key", "fp"])

    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col), key.alias("text_key"), F.col(text_col)).mapInArrow(run, schema)


def embed(fp: Column) -> Column:
    """Bit counts of the two-bit segments, each in unary within its segment."""
    right = F.shiftrightunsigned(fp, 1)
    any_bit = fp.bitwiseOR(right).bitwiseAND(F.lit(_ODD))
    both = fp.bitwiseAND(right).bitwiseAND(F.lit(_ODD))
    return any_bit.bitwiseOR(F.shiftleft(both, 1))


def cell_masks(max_bits: int = MAX_BITS, groups: int = GROUPS) -> list[int]:
    """One mask for each choice of ``groups - max_bits`` groups of whole segments."""
    if groups <= max_bits:
        raise ValueError("more groups than differing bits are needed")
    part = [0] * groups
    for s in range(32):
        part[s * groups // 32] |= 3 << (2 * s)
    return [_signed(sum(part[g] for g in chosen)) for chosen in combinations(range(groups), groups - max_bits)]


def _forest(fps: np.ndarray, embedded: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all fingerprints within ``max_bits`` of each other in one cell."""
    n = len(fps)
    left, right = [], []
    for at in range(0, n, 256):
        rows = slice(at, at + 256)
        near = np.bitwise_count(embedded[rows, None] ^ embedded[None, :]) <= max_bits   # Manhattan, lower bound
        near &= np.bitwise_count(fps[rows, None] ^ fps[None, :]) <= max_bits            # Hamming, exact
        a, b = np.nonzero(near)
        keep = a + at > b
        left.append((a[keep] + at).astype(np.int32))
        right.append(b[keep].astype(np.int32))
    a, b = np.concatenate(left), np.concatenate(right)
    label = np.arange(n)
    while True:  # smallest label spreads over the links, with pointer jumping
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _cell_links(max_bits: int):
    def links(cols: list[np.ndarray]) -> pa.RecordBatch:
        fps, embedded = cols[4].view(np.uint64), cols[5].view(np.uint64)
        new = np.ones(len(fps), dtype=bool)
        new[1:] = False
        for c in cols[:4]:
            new[1:] |= c[1:] != c[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(fps)))
        two = first[size == 2]
        ok = ((np.bitwise_count(embedded[two] ^ embedded[two + 1]) <= max_bits)
              & (np.bitwise_count(fps[two] ^ fps[two + 1]) <= max_bits))
        a, b = [fps[two[ok]]], [fps[two[ok] + 1]]
        for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
            x, y = _forest(fps[at:at + n], embedded[at:at + n], max_bits)
            a.append(x)
            b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            same = np.ones(len(cols[0]), dtype=bool)
            for c in cols[:4]:
                same &= c == c[-1]
            cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0  # start of the last, open cell
            if cut:
                yield links([c[:cut] for c in cols])
            held = [c[cut:] for c in cols]
        if held is not None and len(held[0]):
            yield links(held)

    return run


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS, groups: int = GROUPS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect all fingerprints within ``max_bits``; ``distinct``: one column fp."""
    masks = cell_masks(max_bits, groups)
    choices = F.array(*[F.struct(F.lit(i).alias("cell"), F.col("e").bitwiseAND(F.lit(m)).alias("counts"))
                        for i, m in enumerate(masks)])
    cells = (distinct.select("fp", embed(F.col("fp")).alias("e"))
             .select("fp", "e", F.explode(choices).alias("c")).select("c.cell", "c.counts", "fp", "e"))
    shared = cells.groupBy("cell", "counts").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    n_blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("n_blocks")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("n_blocks") - 1), lambda j: (F.col("n_blocks") == 1) | (j != F.col("own")))
    dealt = (cells.join(shared, ["cell", "counts"]).withColumn("n_blocks", n_blocks).withColumn("own", own)
             .withColumn("other", F.explode(others))
             .select("cell", "counts", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp", "e"))
    keys = ["cell", "counts", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_cell_links(max_bits), "a long, b long")


def _grouped(docs: DataFrame, id_col: str, text_col: str, width: int, max_bits: int, groups: int) -> DataFrame:
    """(``id_col``, text_key, fp, component, component_id) of every row; component tells groups
    apart that have the same least id."""
    prints = scratch(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min(id_col).alias("least_id"))
    found = components(scratch(near_links(distinct.select("fp"), max_bits, groups), "links"))
    placed = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least_id", F.coalesce("component", "fp").alias("component"))
    named = placed.groupBy("component").agg(F.min("least_id").alias("component_id"))
    classes = placed.join(named, "component").select("fp", "component", "component_id")
    return prints.join(classes, "fp").select(id_col, "text_key", "fp", "component", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                    max_bits: int = MAX_BITS, groups: int = GROUPS) -> DataFrame:
    """Fingerprint and component of every row.

    Returns ``id_col``, text_key, fingerprint (16 hex digits) and component_id (smallest
    id reachable over links of at most ``max_bits`` differing bits, itself included).
    Null or empty text has fingerprint zero and links like any other.  A null id never
    names a component (component_id is null only where no row of the component has an
    id).  One result per input row; other columns are not read.
    """
    return _grouped(docs, id_col, text_col, width, max_bits, groups).select(
        id_col, "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component.

    It is the one with the smallest (id, text key); rows without an id come last, so
    one stays only where no row of its component has an id.  Rows that repeat an id
    in different components all stay; of equal rows one does.
    """
    nameless = F.col(id_col).isNull().alias("nameless")
    rows = _grouped(docs, id_col, text_col, width, max_bits, GROUPS)
    least = rows.groupBy("component").agg(F.min(F.struct(nameless, F.col(id_col).alias("id"), "text_key")).alias("least"))
    text_key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))

    def keyed(id_: str, key: Column) -> list[Column]:
        return [F.col(id_).isNull().alias("__nameless"), F.coalesce(F.col(id_).cast("string"), F.lit("")).alias("__id"), key.alias("__key")]

    keys = ["__nameless", "__id", "__key"]
    stay = least.select(*keyed("least.id", F.col("least.text_key")))
    # equal rows meet on the map side first, so a row repeated any number of times never fills one task
    return (docs.select("*", *keyed(id_col, text_key)).dropDuplicates(keys)
            .join(stay, keys, "left_semi").select(*docs.columns))
