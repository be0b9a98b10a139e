"""Substring dedup by prefix-partitioned suffix trees.

A suffix starts at every word; a repeat is a word sequence of ``MIN_WORDS`` that
starts at suffixes of several documents, which is a node of depth ``MIN_WORDS``
or more with several leaves in the suffix tree of all texts.  The tree is never
built as one:

1. Anchors.  Of each ``MIN_WORDS`` window the least hash of its ``ANCHOR``-word
   stretches is its anchor.  Equal windows have equal anchors and neighbouring
   windows mostly share one, so a text becomes a few runs of suffixes by anchor.
   Anchors of one document only are dropped (a map-side combined count): their
   suffixes have no partner.  Nothing is lost, whatever the hashes do.
2. Groups.  The suffixes of the remaining runs are split by prefix, the shared
   stretch of ``ANCHOR`` words, and each group's runs meet in one task.  A group
   above ``GROUP_WORDS`` words gets the longest prefix instead, all words of the
   window: it is split by a 128-bit digest of them and aggregated with a
   map-side combine, so a passage found in a third of all documents is no hot
   task.
3. Subtrees.  A task builds its groups' subtrees down to ``MIN_WORDS`` words, level
   by level: two suffixes share a node of depth 2d if they share one of depth d
   and so do the suffixes d words on.  Words are compared exactly.  Nodes at full
   depth with leaves of several documents are the repeats.

The smallest ``doc_id`` below a node keeps its words; in all others the covered
words are removed, judged on the input.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import scratch

MIN_WORDS = 50
ANCHOR = 12                # words of an anchor stretch
GROUP_WORDS = 400_000      # words of a group one task takes (about 50 MB of arrays)
CHUNK_WORDS = 400_000      # words handled together

_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _windows_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive values."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def _stretch_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Mixed 64-bit hash of every ``size`` consecutive words."""
    x = np.fromiter(map(zlib.crc32, words), dtype=np.uint64, count=len(words)) * _MULTIPLIERS[0]
    x ^= x >> np.uint64(29)
    out, done = None, 0
    power, have, level = x, 1, 0
    while True:  # binary decomposition of ``size``
        if size & have:
            out = power if out is None else out[:len(power) - done] * _MULTIPLIERS[1] + power[done:][:len(out[:len(power) - done])]
            done += have
        have *= 2
        if have > size:
            break
        half = have // 2
        level += 1
        power = power[:-half] * (_MULTIPLIERS[2] + np.uint64(2 * level)) + power[half:] if len(power) > half else power[:0]
    out = out[:len(words) - size + 1] * _MULTIPLIERS[3]
    return out ^ (out >> np.uint64(31))


def anchor_runs(words: list[bytes], min_words: int = MIN_WORDS, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, number of windows) of every run of windows with one anchor."""
    if len(words) < min_words:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    least = _windows_min(_stretch_hashes(words, anchor), min_words - anchor + 1)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    return least[first].view(np.int64), first, np.diff(np.append(first, len(least)))


def deep_nodes(symbols: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Node of depth ``depth`` above each suffix in ``starts``, level by level (exact)."""
    names, have = symbols.astype(np.int64), 1
    while 2 * have <= depth:
        pair = names[:-have] * (int(names.max()) + 1) + names[have:]
        names = np.unique(pair, return_inverse=True)[1]
        have *= 2
    pair = names[starts] * (int(names.max()) + 1) + names[starts + depth - have]
    return np.unique(pair, return_inverse=True)[1]


def _ranges(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last+1 of every run of True."""
    edge = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _key(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _group_ranges(min_words: int):
    """Runs sorted by anchor -> (row_key, a, b): word ranges to remove."""
    def solve(docs: np.ndarray, keys: np.ndarray, firsts: np.ndarray, texts: list[bytes]) -> pa.RecordBatch:
        which: dict[bytes, int] = {}
        kind = np.fromiter((which.setdefault(t, len(which)) for t in texts), dtype=np.int64, count=len(texts))
        owner = np.full(len(which), np.iinfo(np.int64).max)
        np.minimum.at(owner, kind, docs)  # equal runs: only the smallest document counts
        index: dict[bytes, int] = {}
        symbols, sizes = [], []
        for t in which:
            words = t.split()
            sizes.append(len(words))
            symbols.append(np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words)))
        size = np.array(sizes)
        offset = np.concatenate(([0], np.cumsum(size)))[:-1]
        windows = size - min_words + 1
        run = np.repeat(np.arange(len(size)), windows)
        at = np.concatenate(([0], np.cumsum(windows)))
        starts = offset[run] + np.arange(len(run)) - at[run]
        node = deep_nodes(np.concatenate(symbols), starts, min_words)
        least = np.full(int(node.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, node, owner[run])
        best = least[node]
        out_key, out_a, out_b = [], [], []
        for i, k in enumerate(kind.tolist()):
            a, b = _ranges(best[at[k]:at[k + 1]] < docs[i])
            if len(a):
                out_key.append(np.full(len(a), keys[i]))
                out_a.append(firsts[i] + a)
                out_b.append(firsts[i] + b - 1 + min_words)
        join = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(join(x)) for x in (out_key, out_a, out_b)], ["row_key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        words, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if words >= CHUNK_WORDS and row[0] != last:  # groups stay whole
                    yield solve(*(np.array(x, dtype=np.int64) for x in held[1:4]), held[4])
                    held, words = [[], [], [], [], []], 0
                for column, value in zip(held, row):
                    column.append(value)
                last = row[0]
                words += row[4].count(b" ") + 1
        if held[0]:
            yield solve(*(np.array(x, dtype=np.int64) for x in held[1:4]), held[4])

    return run


def _window_names(words: list[bytes], min_words: int) -> list[tuple[int, int, bytes]]:
    """(first window, last + 1, 128-bit digest of the words) of every run of equal windows."""
    import xxhash

    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1)).tolist()
    names = [xxhash.xxh3_128_digest(joined[a:b]) for a, b in zip(begins, ends[min_words - 1:].tolist())]
    at = [i for i, x in enumerate(names) if not i or names[i - 1] != x]
    return [(i, j, names[i]) for i, j in zip(at, [*at[1:], len(names)])]


def _cut(min_words: int):
    """Rows with their wanted runs -> runs with their words, or, of hot groups, windows by digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        names = ["anchor", "doc_id", "row_key", "a", "b", "words", "window"]
        for whole in batches:
            for at in range(0, len(whole), 1000):
                out: list[tuple] = []
                for doc, key, text, own in zip(*(c.to_pylist() for c in whole.slice(at, 1000).columns)):
                    words = text.encode().split()
                    for r in own:
                        first, n = r["first"], r["windows"]
                        part = words[first:first + n + min_words - 1]
                        if r["hot"]:
                            out += [(None, doc, key, first + i, first + j - 1 + min_words, None, name)
                                    for i, j, name in _window_names(part, min_words)]
                        else:
                            out.append((r["anchor"], doc, key, first, first + n, b" ".join(part), None))
                columns = zip(*out) if out else [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def repeated_ranges(rows: DataFrame, min_words: int = MIN_WORDS, anchor: int = ANCHOR, group_words: int = GROUP_WORDS) -> DataFrame:
    """(row_key, ranges): the word ranges [a, b) to remove from each row with any.

    ``rows``: (doc_id long, row_key long, text).
    """
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [anchor_runs((t.as_py() or "").encode().split(), min_words, anchor) for t in batch.column(2)]
            n = np.fromiter((len(x[0]) for x in out), dtype=np.int64, count=len(out))
            take = pa.array(np.repeat(np.arange(len(out)), n))
            cols = [pa.array(np.concatenate([x[i] for x in out]).astype(np.int64)) for i in range(3)]
            yield pa.RecordBatch.from_arrays([cols[0], batch.column(0).take(take), batch.column(1).take(take), *cols[1:]],
                                             ["anchor", "doc_id", "row_key", "first", "windows"])

    runs = scratch(rows.where(F.col("doc_id").isNotNull()).mapInArrow(
        anchors, "anchor long, doc_id long, row_key long, first long, windows long"), "anchors")
    shared = (runs.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
                                         F.sum(F.col("windows") + (min_words - 1)).alias("size"))
              .where("lo < hi").select("anchor", (F.col("size") > group_words).alias("hot")))
    wanted = (runs.join(shared, "anchor").groupBy("row_key")
              .agg(F.collect_set(F.struct("anchor", "hot", "first", "windows")).alias("runs")))
    # the exchange of the texts by row_key is the one the final join reads again
    pieces = rows.join(wanted, "row_key").select("doc_id", "row_key", "text", "runs").mapInArrow(
        _cut(min_words), "anchor long, doc_id long, row_key long, a long, b long, words binary, window binary")
    groups = pieces.where("words is not null").select("anchor", "doc_id", "row_key", "a", "words")
    cool = groups.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _group_ranges(min_words), "row_key long, a long, b long")
    windows = pieces.where("window is not null").select("window", "doc_id", "row_key", "a", "b")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"))
    hot = windows.join(least, "window").where("least < doc_id").select("row_key", "a", "b")
    return cool.unionByName(hot).groupBy("row_key").agg(F.collect_set(F.struct("a", "b")).alias("ranges"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                   anchor: int = ANCHOR, group_words: int = GROUP_WORDS) -> DataFrame:
    """``id_col``, n_words, n_removed and kept (the words left, joined by one space) of every row.

    Null or empty text: no words, kept empty.  Rows without an id neither lose words
    nor take them from others.  Rows that repeat an id count as one document: they
    take nothing from each other.  One result per input row; other columns are not
    read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("row_key", _key("doc_id", "text")).select("doc_id", "row_key", "text")
    ranges = repeated_ranges(rows, min_words, anchor, group_words)
    id_type = docs.schema[id_col].dataType.simpleString()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, kept = [], [], []
            for text, own in zip(batch.column(1), batch.column(2)):
                words = text.as_py().encode().split()
                sizes.append(len(words))
                cuts = own.as_py()
                if cuts:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    np.add.at(edge, [c["a"] for c in cuts], 1)
                    np.add.at(edge, [c["b"] for c in cuts], -1)
                    left = np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()
                    removed.append(len(words) - len(left))
                    words = [words[i] for i in left]
                else:
                    removed.append(0)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept"])

    whole = rows.join(ranges, "row_key", "left").select("doc_id", "text", "ranges")
    out = whole.mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept string")
    return out.select(F.col("doc_id").cast(id_type).alias(id_col), "n_words", "n_removed", "kept")
