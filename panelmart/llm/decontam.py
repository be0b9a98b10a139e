"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact verification.

Items and documents are sequences of normalised words.  The CGK random walk
reads a sequence symbol by symbol: at step ``j`` it writes the symbol under the
cursor and moves on by a random bit that depends on ``j`` and the symbol.  Two
sequences at edit distance ``d`` have walks that differ in few coordinates, so
edit distance becomes Hamming distance.  Each repetition samples ``SAMPLES``
coordinates; item and window meet where all sampled symbols agree.  The number
of repetitions follows from the wanted recall.  Every meeting is verified by the
exact edit distance (Myers' bit-parallel search), so no false match is left.

Windows are item-sized: items are taken in length classes, and a window starts
at every word of every document.  A window is walked only if enough of its word
pairs occur in any item at all: ``d`` edits break at most ``2 d`` of an item's
neighbouring pairs, so this bound follows from the edit limit and loses nothing.

Items of fewer than ``MIN_ITEM_WORDS`` words are too short for sampled coordinates
and are searched by all their windows: with one edit allowed, a match is the
item, the item without a word, or either with one word set in, so windows (one
inner word left out) and items (one word left out) meet by a key.  This loses none.

Map-only: the items travel with the tasks in blocks of a checked size, one pass
over the documents per block, no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.licenses import WORD_BYTES

MAX_EDITS = 0.2           # edits (words) allowed per word of the item: similarity of 0.8 or more
MIN_ITEM_WORDS = 8        # shorter items are searched by window keys, without loss
SAMPLES = 3               # coordinates of one repetition
WALKS = 2                 # independent random walks
TARGET_RECALL = 0.99      # at the edit limit
KEPT_SHARE = 0.52         # coordinates that agree at the edit limit (measured, see tests)
BLOCK_ITEMS = 5_000       # items of one pass, and
BLOCK_BYTES = 8 << 20     # their text
PAIR_MIX = 1_000_003      # folds a pair of word numbers into one place of the pair table
SEED = 42


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def repetitions(recall: float = TARGET_RECALL, kept: float = KEPT_SHARE, samples: int = SAMPLES) -> int:
    """Repetitions after which a pair at the edit limit has met with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - kept ** samples))


def edit_search(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any stretch of ``text`` and the end of the first
    such stretch (Myers, bit-parallel)."""
    m = len(pattern)
    peq: dict[int, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = ph << 1 & mask
        mh = mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Items of one block, compiled: vocabulary, walks, sampled keys."""

    def __init__(self, items: list[tuple], max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL):
        self.ids, self.vocabulary = [], {}
        sequences = []
        for item_id, text in items:
            words = words_of(text)
            if words:
                self.ids.append(item_id)
                sequences.append([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words])
        self.items = sequences
        self.distinct = [set(s) for s in sequences]
        self.edits = [int(max_edits * len(s)) for s in sequences]
        pairs = [a * PAIR_MIX + b for s in sequences if len(s) >= MIN_ITEM_WORDS for a, b in zip(s, s[1:])]
        self.pair_mask = (1 << max(10, (64 * len(pairs)).bit_length())) - 1
        self.is_pair = np.zeros(self.pair_mask + 1, dtype=np.int8)
        self.is_pair[np.array(pairs, dtype=np.int64) & self.pair_mask] = 1
        rng = np.random.default_rng(SEED)
        self.classes = []
        by_length = sorted((i for i, s in enumerate(sequences) if len(s) >= MIN_ITEM_WORDS), key=lambda i: len(sequences[i]))
        while by_length:
            shortest = len(sequences[by_length[0]])
            members = [i for i in by_length if len(sequences[i]) <= shortest * 1.25]
            by_length = by_length[len(members):]
            steps = max(2, int(1.6 * shortest))  # a walk reads a symbol every two steps: inside the shortest item
            limit = max(self.edits[i] for i in members)
            self.classes.append((shortest, limit, steps, self._tables(members, steps, recall, rng)))
        self.longest = max(map(len, sequences), default=0)
        self._short_tables()

    def _tables(self, members: list[int], steps: int, recall: float, rng) -> list:
        """Per walk: its random bits, and per repetition the sampled coordinates and item keys."""
        flat = np.zeros(sum(len(self.items[i]) + 2 * steps for i in members), dtype=np.int32)
        starts, at = [], 0
        for i in members:
            flat[at:at + len(self.items[i])] = self.items[i]
            starts.append(at)
            at += len(self.items[i]) + 2 * steps
        total = repetitions(recall)
        out = []
        for walk in range(WALKS):
            bits = rng.integers(0, 2, (steps, len(self.vocabulary) + 1), dtype=np.int8)
            n_reps = len(range(walk, total, WALKS))
            plan: list[list[tuple[int, np.uint64]]] = [[] for _ in range(steps)]  # step -> (repetition, factor)
            for rep in range(n_reps):
                for j in rng.choice(steps, SAMPLES, replace=False).tolist():
                    plan[j].append((rep, rng.integers(1, 2**63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)))
            tables = []
            for key in self._keys(flat, np.array(starts), bits, plan, n_reps):
                order = np.argsort(key, kind="stable")
                tables.append((key[order], np.array(members)[order]))
            out.append((bits, plan, tables))
        return out

    def _short_tables(self) -> None:
        """Keys of the short items by window: (words of the window, inner word left out) -> sorted keys, owners."""
        rng = np.random.default_rng(SEED + 1)
        self.value = rng.integers(1, 2**63, len(self.vocabulary) + 1, dtype=np.uint64)
        self.factor = rng.integers(1, 2**63, MIN_ITEM_WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.in_short = np.zeros(len(self.vocabulary) + 1, dtype=bool)
        wanted: dict[tuple[int, int | None], set[tuple[int, int]]] = {}
        self.by_word: dict[int, list[int]] = {}  # items with more edits allowed than the keys cover
        for i, item in enumerate(self.items):
            n, limit = len(item), self.edits[i]
            if n >= MIN_ITEM_WORDS:
                continue
            if limit > 1 or limit >= n:
                for w in set(item):
                    self.by_word.setdefault(w, []).append(i)
                continue
            self.in_short[item] = True
            without = [self._key(item[:k] + item[k + 1:]) for k in range(n)]
            uses = [((n, None), self._key(item))]
            if limit:
                uses += [((n, k), without[k]) for k in range(1, n - 1)]          # a word changed
                uses += [((n - 1, None), key) for key in without]                # a word lost
                uses += [((n + 1, k), self._key(item)) for k in range(1, n)]     # a word set in
            for window, key in uses:
                wanted.setdefault(window, set()).add((key, i))
        self.short = []
        for window, pairs in wanted.items():
            rows = sorted(pairs)
            self.short.append((*window, np.array([k for k, _ in rows], dtype=np.uint64), np.array([i for _, i in rows])))

    def _key(self, words: list[int]) -> int:
        return int((self.value[words] * self.factor[:len(words)]).sum(dtype=np.uint64))

    def _find_short(self, flat: np.ndarray, entries: np.ndarray, n: int) -> set[tuple[int, int]]:
        """(place, item) of the short items' candidates; of equal windows of a text the first."""
        found: set[tuple[int, int]] = set()
        known = self.in_short[flat]
        for size, left_out, keys, owners in self.short:
            place = np.flatnonzero(known[:n] & known[size - 1:size - 1 + n])
            key = np.zeros(len(place), dtype=np.uint64)
            for j, k in enumerate(k for k in range(size) if k != left_out):
                key += self.value[flat[place + k]] * self.factor[j]
            first = np.searchsorted(keys, key)
            hit = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == key)
            if not len(hit):
                continue
            place, first = place[hit], first[hit]
            row = np.searchsorted(entries, place, side="right")
            _, once = np.unique(row * (len(keys) + 1) + first, return_index=True)
            place, first = place[once], first[once]
            count = np.searchsorted(keys, keys[first], side="right") - first
            at = np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
            found.update(zip(np.repeat(place, count).tolist(), owners[at].tolist()))
        if self.by_word:
            for p in np.flatnonzero(np.isin(flat[:n], list(self.by_word))).tolist():
                found.update((p, i) for i in self.by_word[int(flat[p])])
        return found

    @staticmethod
    def _keys(flat: np.ndarray, starts: np.ndarray, bits: np.ndarray, plan: list, n_reps: int) -> list[np.ndarray]:
        """Key of every start in every repetition: a mix of the sampled symbols of its walk."""
        keys = [np.zeros(len(starts), dtype=np.uint64) for _ in range(n_reps)]
        cursor = starts.copy()
        for j, uses in enumerate(plan):
            symbol = flat[cursor]
            if uses:
                value = symbol.astype(np.uint64) + np.uint64(1)
                for rep, factor in uses:
                    keys[rep] += value * factor
            cursor += bits[j][symbol]
        return keys

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int, int, int]]:
        """(text number, item number, edits, first word, words) of the best place of every
        item in every text, within the edit limit."""
        if not self.items:
            return []
        get, pad = self.vocabulary.get, 2 * self.longest + 2
        parts, starts, at = [np.zeros(pad, dtype=np.int32)], [], pad
        for text in texts:
            words = words_of(text)
            ids = np.fromiter(map(get, words, repeat(0)), dtype=np.int32, count=len(words))
            parts += [ids, np.zeros(pad, dtype=np.int32)]
            starts.append(at)
            at += len(ids) + pad
        flat = np.concatenate(parts)
        if not starts:
            return []
        ends = np.array([s + len(ids) for s, ids in zip(starts, parts[1::2])])
        pair = self.is_pair[(flat[:-1].astype(np.int64) * PAIR_MIX + flat[1:]) & self.pair_mask]
        pair[(flat[:-1] == 0) | (flat[1:] == 0)] = 0
        entries = np.array(starts) - max(self.edits)  # an item may have lost its first words at a text's beginning
        known = np.concatenate(([0], np.cumsum(pair, dtype=np.int32)))  # item pairs before each place
        n = len(flat) - pad
        found = self._find_short(flat, entries, n) if self.short or self.by_word else set()
        for shortest, limit, _, walks in self.classes:
            wide = shortest + limit - 1
            near = np.flatnonzero(known[wide:wide + n] - known[:n] >= shortest - 1 - 2 * limit)
            near = near[near >= entries[0]]
            near = near[near < ends[np.searchsorted(entries, near, side="right") - 1]]
            for bits, plan, tables in walks:
                for lo in range(0, len(near), 1 << 15):
                    part = near[lo:lo + (1 << 15)]
                    for key, (keys, owners) in zip(self._keys(flat, part, bits, plan, len(tables)), tables):
                        left = np.searchsorted(keys, key)
                        hit = np.flatnonzero(keys[np.minimum(left, len(keys) - 1)] == key)
                        for p, k in zip(part[hit].tolist(), left[hit].tolist()):
                            wanted = keys[k]
                            while k < len(keys) and keys[k] == wanted:
                                found.add((p, int(owners[k])))
                                k += 1
        return self._verify(flat, starts, entries, ends, found)

    def _verify(self, flat: np.ndarray, starts: list[int], entries: np.ndarray, ends: np.ndarray, found: set[tuple[int, int]]) -> list:
        rows = np.searchsorted(entries, np.array([p for p, _ in found], dtype=np.int64), side="right") - 1
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for (p, i), row in sorted(zip(found, rows.tolist())):
            known = best.get((row, i))
            if known is not None and known[0] == 0:
                continue
            item, limit = self.items[i], self.edits[i]
            lo = max(starts[row], p - limit)
            window = flat[lo:min(p + len(item) + limit, int(ends[row]))].tolist()
            if len(self.distinct[i].difference(window)) > limit:  # every missing word costs an edit
                continue
            edits, end = edit_search(item, window)
            if edits > limit or (known is not None and known[0] <= edits):
                continue
            _, back = edit_search(item[::-1], window[:end][::-1])
            best[row, i] = (edits, lo + end - back - starts[row], back)
        return [(row, i, *place) for (row, i), place in best.items()]


def item_blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items in blocks of at most about ``BLOCK_ITEMS`` items and ``BLOCK_BYTES`` of text.

    One block is on the driver at a time; null and empty texts are left out.
    """
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(1, -(-size.n // BLOCK_ITEMS), -(-(size.b or 0) // BLOCK_BYTES))
    slot = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for block in range(blocks):
        yield [(r.id, r.text) for r in rows.where(slot == block).collect()]


def _batches(batch: pa.RecordBatch, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text: str = "text", max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL) -> DataFrame:
    """Items found in documents: ``id_col``, ``item_col``, edits, similarity, first_word, n_words.

    One row per document row and item, the place with the fewest edits.  Null or empty
    texts match nothing; null ids and repeated rows are kept as they come; items without
    a word are not searched.  Empty tables give an empty result; other columns are not
    read.
    """
    item_type = items.schema[item_col].dataType
    schema = (f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, `{item_col}` {item_type.simpleString()}, "
              "edits int, similarity double, first_word long, n_words long")
    out = None
    for block in item_blocks(items, item_col, item_text):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            matcher = Matcher(block, max_edits, recall)
            for batch in (b for whole in batches for b in _batches(whole)):
                hits = sorted(matcher.search(batch.column(1).to_pylist()))
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([h[0] for h in hits], pa.int64())),
                         pa.array([matcher.ids[h[1]] for h in hits], to_arrow_type(item_type)),
                         pa.array([h[2] for h in hits], pa.int32()),
                         pa.array([1 - h[2] / len(matcher.items[h[1]]) for h in hits], pa.float64()),
                         pa.array([h[3] for h in hits], pa.int64()), pa.array([h[4] for h in hits], pa.int64())],
                        [id_col, item_col, "edits", "similarity", "first_word", "n_words"])

        part = docs.select(id_col, text_col).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
               max_edits: float = MAX_EDITS, recall: float = TARGET_RECALL) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no item; same rules as ``find_leaks``."""
    at = docs.columns.index(text_col)
    for block in item_blocks(items, item_col, item_text):
        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, max_edits, recall)
            for batch in (b for whole in batches for b in _batches(whole)):
                keep = np.ones(len(batch), dtype=bool)
                keep[[h[0] for h in matcher.search(batch.column(at).to_pylist())]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
