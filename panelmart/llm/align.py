"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes.

A is a byte-level BPE over space+text, B a SentencePiece model over text (it adds the
space).  The byte offsets where a token of A and one of B both end cut the tokens into
groups.  The two tokens that end at a cut are a link; its count is the number of links
of the corpus with the same pair of ids.

Fragment monoid: the tokens that end within a byte range are a fragment: an open prefix
(up to its first cut), closed groups, and an open suffix (after its last cut); a
fragment without a cut is all prefix.  ``compose`` joins neighbours: the left one's
suffix and the right one's prefix become a closed group.  It is associative, so ranges
are reduced as a tree: those of a task in the task, then ``FAN`` pieces of a document a
level, each in a Spark group of at most ``FAN`` rows.

Texts above ``PIECE`` characters are cut into pieces that Spark tokenizes apart, at
single spaces between other characters: a pre-token of A begins there, and no piece of B
holds a space after another character (checked when the model is loaded).

Link counts: bytes that end together make one token's bytes a suffix of the other's, so
the pairs are at most as many as the bytes of both vocabularies (``pair_bound``, about
half a million), whatever the corpus; their counts are broadcast behind that bound.

A document has no tokens where its text is null or empty or the joined bytes of A or B
differ from space+text (a literal U+2581, say): zeros, an empty digest, and no part in
any count.  Null ids and repeated rows keep their rows, one result per input row.  Empty
tables give no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelmart.llm.common import once_per_worker, scratch

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE = 1 << 16    # characters of a long text that are tokenized together, at least
RANGE = 1 << 13    # bytes of a fragment
FAN = 16           # fragments composed together in one group
LONG_RUN = 2000    # characters without white space that go to the slower library
_STEP = 500        # texts tokenized at a time
_SPACE = "▁"


# ---------------------------------------------------------------- the monoid

@dataclass
class Fragment:
    """Tokens that end in one byte range; ``closed``: rendered groups; ``n_groups``: cuts."""

    head_a: list = field(default_factory=list)
    head_b: list = field(default_factory=list)
    closed: list = field(default_factory=list)
    tail_a: list = field(default_factory=list)
    tail_b: list = field(default_factory=list)
    n_groups: int = 0
    n_a: int = 0
    n_b: int = 0


def render(a: list, b: list) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of both ranges, ``x`` before ``y``; ``Fragment()`` is neutral."""
    sizes = (x.n_groups + y.n_groups, x.n_a + y.n_a, x.n_b + y.n_b)
    if not x.n_groups:
        return Fragment(x.head_a + y.head_a, x.head_b + y.head_b, y.closed, y.tail_a, y.tail_b, *sizes)
    if not y.n_groups:
        return Fragment(x.head_a, x.head_b, x.closed, x.tail_a + y.head_a, x.tail_b + y.head_b, *sizes)
    between = render(x.tail_a + y.head_a, x.tail_b + y.head_b)
    return Fragment(x.head_a, x.head_b, [*x.closed, between, *y.closed], y.tail_a, y.tail_b, *sizes)


def reduce_tree(parts: list[Fragment]) -> Fragment:
    while len(parts) > 1:
        parts = [compose(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else Fragment()


def lift(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> Fragment:
    """The fragment of the tokens of one range, from the offsets where they end."""
    ids_a, ids_b = a.tolist(), b.tolist()
    cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
    if not len(cuts):
        return Fragment(ids_a, ids_b, n_a=len(a), n_b=len(b))
    at_a, at_b = (np.searchsorted(ends_a, cuts) + 1).tolist(), (np.searchsorted(ends_b, cuts) + 1).tolist()
    closed = [f"{ids_a[p]}|{ids_b[r]}" if q - p == 1 and s - r == 1 else render(ids_a[p:q], ids_b[r:s])
              for p, q, r, s in zip(at_a, at_a[1:], at_b, at_b[1:])]
    return Fragment(ids_a[:at_a[0]], ids_b[:at_b[0]], closed, ids_a[at_a[-1]:], ids_b[at_b[-1]:], len(cuts), len(a), len(b))


def groups_text(x: Fragment) -> str:
    """``a1,a2|b1;a3|b2,b3`` of a whole document (its start is a border, its end a cut)."""
    return ";".join([render(x.head_a, x.head_b), *x.closed]) if x.n_groups else ""


# ---------------------------------------------------------------- the tokenizers

def _byte_of_char() -> dict[str, int]:
    """Byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256 and up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in own}
    for n, b in enumerate(b for b in range(256) if b not in set(own)):
        out[chr(256 + n)] = b
    return out


class Pair:
    """Both tokenizers, and the bytes of each token."""

    def __init__(self, a_path: str, b_path: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        byte = _byte_of_char()
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in token)
        merges = [m if isinstance(m, str) else " ".join(m) for m in spec["model"]["merges"]]
        if [vocab[m.replace(" ", "")] for m in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("ids of A are not in the order of its merges")
        # ids in merge order are the ranks of the faster library; long runs go to the file's own
        self.a_fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                        mergeable_ranks={t: i for i, t in enumerate(self.a_bytes) if t})
        self.a_slow = Tokenizer.from_file(a_path)
        self.a_slow.encode_special_tokens = True   # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:-1], 16)]))
                continue
            if _SPACE in piece.lstrip(_SPACE):
                raise ValueError("a piece of B holds a space after another character")
            self.b_bytes.append(piece.replace(_SPACE, " ").encode())
        self.a_sizes = np.array([len(t) for t in self.a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], dtype=np.int64)
        self.long_run = re.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

    def a_ids(self, text: str) -> list[int]:
        if self.long_run.search(text):
            return self.a_slow.encode(text, add_special_tokens=False).ids
        return self.a_fast.encode_ordinary(text)

    def pair_bound(self) -> int:
        """Pairs of ids that can end together: each names a token and a suffix of its bytes."""
        return int(self.a_sizes.sum() + self.b_sizes.sum())

    def fragments(self, texts: list[str]) -> Iterator[tuple[Fragment | None, np.ndarray]]:
        """(fragment, link codes) of each text; no fragment where the bytes differ."""
        for text, ids_b in zip(texts, self.b.encode(texts, num_threads=1)):
            ids_a = self.a_ids(" " + text)
            data = (" " + text).encode()
            if b"".join(map(self.a_bytes.__getitem__, ids_a)) != data or b"".join(map(self.b_bytes.__getitem__, ids_b)) != data:
                yield None, np.zeros(0, dtype=np.int64)
                continue
            a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
            ends_a, ends_b = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
            borders = np.arange(RANGE, len(data) + RANGE, RANGE)
            cut_a, cut_b = [0, *np.searchsorted(ends_a, borders, "right").tolist()], [0, *np.searchsorted(ends_b, borders, "right").tolist()]
            parts = [lift(a[p:q], ends_a[p:q], b[r:s], ends_b[r:s]) for p, q, r, s in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
            _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
            yield reduce_tree(parts), a[at_a] << 32 | b[at_b]


def pieces(text: str, size: int = PIECE) -> list[str]:
    """The text cut at single spaces (left out) between other characters, ``size`` apart at least."""
    out, start = [], 0
    place = re.compile(r"(?<=\S) (?=\S)")
    while (found := place.search(text, start + size)) is not None:
        out.append(text[start:found.start()])
        start = found.end()
    return [*out, text[start:]]


# ---------------------------------------------------------------- Spark

_OWN = "n_a long, n_b long, n_groups long"
_LINKS = "codes binary, counts binary"
_FRAGMENT = f"{_OWN}, head_a array<int>, head_b array<int>, closed string, tail_a array<int>, tail_b array<int>"


def _counted(codes: np.ndarray) -> tuple[bytes, bytes]:
    found, n = np.unique(codes, return_counts=True)
    return found.tobytes(), n.astype(np.int64).tobytes()


def _digest(x: Fragment | None) -> str:
    return hashlib.sha256(groups_text(x).encode()).hexdigest() if x is not None and x.n_groups else ""


def _whole(docs: DataFrame, id_col: str, id_type: str, a_path: str, b_path: str) -> DataFrame:
    """Short texts: their result but for the counts, and their links."""
    names = [id_col, "n_a", "n_b", "n_groups", "groups_sha256", "codes", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = once_per_worker(f"align:{a_path}:{b_path}", lambda: Pair(a_path, b_path))
        for batch in batches:
            for at in range(0, len(batch), _STEP):
                part = batch.slice(at, _STEP)
                rows = []
                for x, codes in pair.fragments(part.column(1).to_pylist()):
                    x = x if x is not None and x.n_groups else Fragment()
                    rows.append((x.n_a, x.n_b, x.n_groups, _digest(x), *_counted(codes if x.n_groups else codes[:0])))
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, zip(*rows))], names)

    return docs.mapInArrow(run, f"`{id_col}` {id_type}, {_OWN}, groups_sha256 string, {_LINKS}")


def _split(docs: DataFrame, size: int) -> DataFrame:
    """Long texts (key, text) as pieces (key, place, piece)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts = pieces(text.as_py(), size)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(parts)), pa.array(range(len(parts)), pa.int64()), pa.array(parts)],
                                                 ["key", "place", "piece"])

    return docs.mapInArrow(run, "key long, place long, piece string")


def _pieces(parts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Fragment and links of every piece; ``bad`` where its bytes differ."""
    schema = f"key long, place long, bad boolean, {_FRAGMENT}, {_LINKS}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = once_per_worker(f"align:{a_path}:{b_path}", lambda: Pair(a_path, b_path))
        for batch in batches:
            rows = []
            for key, place, (x, codes) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), pair.fragments(batch.column(2).to_pylist())):
                rows.append((key, place, x is None, *_row(x or Fragment()), *_counted(codes)))
            if rows:
                frame = pd.DataFrame(rows, columns=["key", "place", "bad", *_FIELDS, "codes", "counts"])
                yield pa.RecordBatch.from_pandas(frame, schema=_PIECE_SCHEMA, preserve_index=False)

    return parts.mapInArrow(run, schema)


_FIELDS = ["n_a", "n_b", "n_groups", "head_a", "head_b", "closed", "tail_a", "tail_b"]
_IDS = pa.list_(pa.int32())
_PIECE_SCHEMA = pa.schema([("key", pa.int64()), ("place", pa.int64()), ("bad", pa.bool_()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                           ("n_groups", pa.int64()), ("head_a", _IDS), ("head_b", _IDS), ("closed", pa.string()), ("tail_a", _IDS),
                           ("tail_b", _IDS), ("codes", pa.binary()), ("counts", pa.binary())])


def _row(x: Fragment) -> tuple:
    return x.n_a, x.n_b, x.n_groups, x.head_a, x.head_b, ";".join(x.closed), x.tail_a, x.tail_b


def _fragment(r) -> Fragment:
    return Fragment(list(r.head_a), list(r.head_b), [r.closed] if r.closed else [], list(r.tail_a), list(r.tail_b), r.n_groups, r.n_a, r.n_b)


def _composed(parts: DataFrame) -> DataFrame:
    """One level of the tree: ``FAN`` neighbours of a document become one."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        whole = reduce_tree([_fragment(r) for r in group.itertuples(index=False)])
        return pd.DataFrame([(group["key"].iat[0], group["place"].iat[0] // FAN, *_row(whole))], columns=["key", "place", *_FIELDS])

    return parts.groupBy("key", F.floor(F.col("place") / FAN).alias("parent")).applyInPandas(run, f"key long, place long, {_FRAGMENT}")


def _rooted(parts: DataFrame) -> DataFrame:
    """(key, n_a, n_b, n_groups, groups_sha256) of every long document."""
    most = parts.agg(F.max("place")).first()[0] or 0
    nodes = parts.select("key", "place", *_FIELDS)
    while most > 0:
        nodes, most = scratch(_composed(nodes), "align-level"), most // FAN

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            digests = [_digest(_fragment(r)) for r in frame.itertuples(index=False)]
            yield frame[["key", "n_a", "n_b", "n_groups"]].assign(groups_sha256=digests)

    return nodes.mapInPandas(run, f"key long, {_OWN}, groups_sha256 string")


def _link_counts(links: DataFrame, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of the corpus, by code; at most ``bound`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            more = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.int64)
            n = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.int64)
            codes, where = np.unique(np.concatenate((codes, more)), return_inverse=True)
            total = np.zeros(len(codes), dtype=np.int64)
            np.add.at(total, where, np.concatenate((counts, n)))
            counts = total
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

    found = links.select("codes", "counts").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).limit(bound + 1).toPandas()
    if len(found) > bound:
        raise ValueError("more pairs of ids than their bytes allow")
    found = found.sort_values("code")
    return found["code"].to_numpy(dtype=np.int64), found["n"].to_numpy(dtype=np.int64)


def _scored(rows: DataFrame, codes: np.ndarray, totals: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep``, n_best and count_sum of every row, from its links."""
    b = codes & 0xFFFFFFFF
    highest = np.zeros(int(b.max()) + 1 if len(b) else 1, dtype=np.int64)
    np.maximum.at(highest, b, totals)
    held = rows.sparkSession.sparkContext.broadcast((codes, totals, totals == highest[b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count, best = held.value
        for batch in batches:
            n_best, count_sum = [], []
            for own, n in zip(batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()):
                at = np.searchsorted(known, np.frombuffer(own, dtype=np.int64))
                n = np.frombuffer(n, dtype=np.int64)
                n_best.append(int(n[best[at]].sum()))
                count_sum.append(int((n * count[at]).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                                             [*keep, "n_best", "count_sum"])

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep]
    return rows.select(*[F.col(f"`{c}`") for c in keep], "codes", "counts").mapInArrow(run, ", ".join([*kinds, "n_best long, count_sum long"]))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE) -> DataFrame:
    """``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"))
    short = scratch(_whole(rows.where(F.length("__text") <= piece), id_col, id_type, a_path, b_path), "align-short")

    long_rows = scratch(rows.where(F.length("__text") > piece).select(F.monotonically_increasing_id().alias("key"), id_col, "__text"), "align-texts")
    cut = scratch(_split(long_rows.select("key", "__text"), piece), "align-pieces")
    parts = scratch(_pieces(cut.repartition("key", "place"), a_path, b_path), "align-fragments")
    bad = parts.where("bad").select("key").distinct()
    good = parts.join(bad, "key", "left_anti")

    links = short.select("codes", "counts").unionByName(good.select("codes", "counts"))
    codes, totals = _link_counts(links, Pair(a_path, b_path).pair_bound())

    own = [id_col, "n_a", "n_b", "n_groups", "groups_sha256"]
    sums = _scored(good, codes, totals, ["key"]).groupBy("key").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = long_rows.select("key", id_col).join(_rooted(good), "key", "left").join(sums, "key", "left")
    whole = whole.select(*own, "n_best", "count_sum").fillna(0, ["n_a", "n_b", "n_groups", "n_best", "count_sum"]).fillna("", ["groups_sha256"])
    out = _scored(short, codes, totals, own).unionByName(whole)
    # a cut ends one token of A and one of B, so every group has one link
    return out.select(id_col, "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256")
