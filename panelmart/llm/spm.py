"""SentencePiece encoding and decoding by a weighted finite-state transducer.

The compiled machine has three parts: the normaliser (dummy prefix, space to
U+2581), the lexicon of pieces and the byte fallback of every other character.
An input is composed with it as a lattice: one state per character position,
one arc per piece that spells the characters between two positions, weighted
with the negated score, and byte arcs where no piece covers a character.  The
encoding is the shortest path in the tropical semiring (min, +).

For a BPE vocabulary the machine carries the merge order as arc constraints:
an arc may follow another only if merging the two pieces' text yields exactly
these two pieces.  A piece sequence is the BPE result if and only if all its
neighbours pass that test, so one path per position survives and it is the one
the merges give.  (The plain sum of BPE scores would rank paths wrongly.)
Pairs are tested once and memoised.  Vocabularies trained as unigram models
have no constraint: the shortest path is the Viterbi segmentation.

Texts are composed piecewise: no piece spans a place before a run of U+2581, beside
a line feed (where no piece holds one), after a run of letters (likewise) or between two characters that no piece has side by side, so the path through a
whole text is the join of the paths through such units; a bounded memo keeps
the paths of frequent units, and between tasks only ``HELD`` of them: a worker that waits
or runs another stage holds little.  Map-only: no shuffle, one row at a time.
"""

from __future__ import annotations

import marshal
import re
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelmart.llm.common import Memo, once_per_worker

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
RUNS = re.compile(r"[^\W\d_]+|[\W\d_]")
LETTER = re.compile(r"[^\W\d_]")
MEMO = 350_000     # units of a generation of the workers' memo
HELD = 30_000      # units that outlive a task
LONGEST = 64       # characters of a unit that is remembered


class Transducer:
    """Pieces, scores and byte fallback of one vocabulary, compiled for composition."""

    def __init__(self, pieces: list[tuple[str, float]], special: set[int], byte_ids: dict[int, int],
                 unknown: int, merges: bool):
        self.text = [p for p, _ in pieces]
        self.cost = [-s for _, s in pieces]
        self.byte_ids, self.unknown, self.merges = byte_ids, unknown, merges
        hidden = special | set(byte_ids.values()) | {unknown}
        self.lexicon = {p: i for i, (p, _) in enumerate(pieces) if i not in hidden and p}
        # the lexicon as a trie: every prefix of a piece, with the piece's id where it is one
        self.arcs = {p[:i]: -1 for p in self.lexicon for i in range(1, len(p))} | self.lexicon
        self.pairs = {p[i:i + 2] for p in self.lexicon for i in range(len(p) - 1)}
        self.chars = {c for p in self.lexicon for c in p}
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.lexicon)
        # units end beside a line feed (where no piece holds one) and after a run of letters,
        # unless it ends with a letter that some piece has before another character
        feed = "" if "\n" in self.chars else "\n"
        joined = "".join(sorted({re.escape(p[0]) for p in self.pairs if LETTER.match(p) and not LETTER.match(p[1])}))
        letters, other = r"[^\W\d_]", rf"(?:[^\w{SPACE}{feed}]|[\d_])"
        more = f"(?:(?<=[{joined}]){other}+{letters}*)*" if joined else ""
        self.units = re.compile("|".join([f"{SPACE}*{other}*{letters}+{more}", f"{SPACE}*{other}+", f"{SPACE}+", *([f"{feed}+"] if feed else [])]))
        surface = [p.replace(SPACE, " ").encode() for p in self.text]
        for b, i in byte_ids.items():
            surface[i] = bytes([b])
        for i in special:
            surface[i] = b""
        surface[unknown] = " ⁇ ".encode()
        self.surface = surface
        self.follows: dict[int, bool] = {}  # left * pieces + right
        self.paths, self.parts = Memo(MEMO), Memo(MEMO // 8)  # of units, of stretches inside units

    @classmethod
    def load(cls, path: str) -> Transducer:
        """Read the vocabulary of a SentencePiece model file."""
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(sp.serialized_model_proto())
        n = sp.get_piece_size()
        norm = proto.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not (norm.add_dummy_prefix and norm.escape_whitespaces):
            raise ValueError(f"{path}: only the identity normaliser with a dummy prefix and escaped spaces is compiled")
        if proto.trainer_spec.treat_whitespace_as_suffix or any(p.type == p.USER_DEFINED for p in proto.pieces):
            raise ValueError(f"{path}: suffix spaces and user-defined pieces are not compiled")
        return cls([(sp.id_to_piece(i), sp.get_score(i)) for i in range(n)],
                   {i for i in range(n) if sp.is_control(i) or sp.is_unused(i)},
                   {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)},
                   sp.unk_id(), proto.trainer_spec.model_type == proto.trainer_spec.BPE)

    def merged(self, text: str) -> list[int | str]:
        """Pieces (or single characters) left when the best-scored neighbours merge, leftmost first."""
        parts: list[str] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        lexicon, cost, end = self.lexicon, self.cost, len(parts)
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < end:
                both = parts[i] + parts[after[i]]
                if both in lexicon:
                    heappush(heap, (cost[lexicon[both]], i, both))

        for i in range(end - 1):
            offer(i)
        while heap:
            _, i, both = heappop(heap)
            if not parts[i] or after[i] >= end or parts[i] + parts[after[i]] != both:
                continue
            gone = after[i]
            parts[i], parts[gone], after[i] = both, "", after[gone]
            if after[i] < end:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [lexicon.get(p, p) for p in parts if p]

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the merge order lets ``right`` stand after ``left``."""
        key = left * len(self.text) + right
        known = self.follows.get(key)
        if known is None:
            known = self.merged(self.text[left] + self.text[right]) == [left, right]
            if len(self.follows) >= MEMO:
                self.follows.clear()
            self.follows[key] = known
        return known

    def shortest(self, unit: str) -> list[int]:
        """Tropical shortest path through the lattice of ``unit``; empty where pieces don't cover it."""
        n, arcs, cost = len(unit), self.arcs, self.cost
        total: list[float | None] = [0.0] + [None] * n
        last = [-1] * (n + 1)
        for j in range(n):
            if total[j] is None:
                continue
            for i in range(j + 1, n + 1):
                piece = arcs.get(unit[j:i])
                if piece is None:  # no piece starts like this
                    break
                if piece >= 0 and (total[i] is None or total[j] + cost[piece] < total[i]):
                    total[i], last[i] = total[j] + cost[piece], piece
        if total[n] is None:
            return []
        out, i = [], n
        while i:
            out.append(last[i])
            i -= len(self.text[last[i]])
        return out[::-1]

    def only_path(self, unit: str) -> list[int]:
        """The shortest path under the merge constraints; empty where pieces don't cover ``unit``.

        All but one path weigh infinity, so the first complete path is the shortest:
        the search takes long arcs first and marks positions that lead nowhere (a
        position is entered by one piece only: the last one of its own encoding).
        """
        n, arcs, follows, pieces = len(unit), self.arcs, self.follows, len(self.text)
        dead: set[tuple[int, int]] = set()
        path: list[int] = []
        stack: list[tuple[int, list[tuple[int, int]]]] = []
        at, left = 0, -1
        while True:
            found: list[tuple[int, int]] = []
            for i in range(at + 1, n + 1):
                piece = arcs.get(unit[at:i])
                if piece is None:
                    break
                if piece >= 0:
                    found.append((i, piece))
            while True:  # longest arc that may follow, else back to the last choice
                step = None
                while found:
                    i, piece = found.pop()
                    if (i, piece) in dead:
                        continue
                    if left >= 0:
                        fits = follows.get(left * pieces + piece)
                        if not (self.may_follow(left, piece) if fits is None else fits):
                            continue
                    step = (i, piece)
                    break
                if step is not None:
                    break
                if not stack:
                    return []
                dead.add((at, left))
                path.pop()
                at, found = stack.pop()
                left = path[-1] if path else -1
            stack.append((at, found))
            at, left = step
            path.append(left)
            if at == n:
                return path

    def _fallback(self, part: str | int) -> list[int]:
        if isinstance(part, int):
            return [part]
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in part.encode()]

    def _stretch(self, part: str) -> list[int]:
        if self.merges and SPACE * 2 in part:
            return []  # space pieces share one score: only the merges tell their order
        return self.only_path(part) if self.merges else self.shortest(part)

    def path(self, unit: str) -> bytes:
        """Ids of one unit as little-endian 32-bit integers."""
        parts = [unit] if unit.lstrip(SPACE).isalpha() and unit[1:2] != SPACE else RUNS.findall(unit)
        if len(parts) > 1:  # join runs that a piece may span
            runs, parts = parts, [parts[0]]
            for run in runs[1:]:
                if parts[-1][-1] + run[0] in self.pairs:
                    parts[-1] += run
                else:
                    parts.append(run)
        out: list[int] = []
        for part in parts:
            if len(parts) == 1 or len(part) > LONGEST:
                out += self._stretch(part) or self._covered(part)
                continue
            for fresh in self.parts.missing([part]):
                self.parts.now[fresh] = self._stretch(fresh) or self._covered(fresh)
            out += self.parts.now[part]
        return np.array(out, dtype="<i4").tobytes()

    def _covered(self, part: str) -> list[int]:
        """Ids of a stretch with characters no piece covers, or with runs of spaces."""
        out: list[int] = []
        start = 0
        for end in range(1, len(part) + 1):
            if end < len(part) and part[end - 1:end + 1] in self.pairs:
                continue
            bit, start = part[start:end], end
            ids = self._stretch(bit) if len(bit) > 1 else []
            out += ids or [x for p in self.merged(bit) for x in self._fallback(p)]
        return out

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype="<i4")
        normal = SPACE + text.replace(" ", SPACE)
        units = self.units.findall(normal) if self.by_word else [normal]
        if max(map(len, units)) > LONGEST:  # rare: stretches too long to remember
            return np.frombuffer(b"".join(map(self.path, units)), dtype="<i4")
        for unit in self.paths.missing(units):
            self.paths.now[unit] = self.path(unit)
        return np.frombuffer(b"".join(map(self.paths.now.__getitem__, units)), dtype="<i4")

    def rest(self) -> None:
        """Forget all but ``HELD`` early asked units; what is left is packed, so that memory goes back."""
        left = marshal.dumps((self.paths.early(HELD), self.parts.early(HELD // 8), self.follows))
        self.paths, self.parts, self.follows = Memo(MEMO), Memo(MEMO // 8), {}
        self.paths.now, self.parts.now, self.follows = marshal.loads(left)
        pa.default_memory_pool().release_unused()

    def decode(self, ids) -> str:
        """The inverse transducer: pieces and bytes to text, without the dummy prefix."""
        surface = self.surface
        data = b"".join([surface[i] for i in ids])
        return data.removeprefix(b" ").decode("utf-8", "replace")


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     keep: tuple[str, ...] = ()) -> DataFrame:
    """Ids and decoded text of every row.

    Returns ``id_col``, the ``keep`` columns, n_ids, ids (array of int) and decoded (the
    text the ids give back).  Null or empty text: no ids, decoded empty.  Null ids and
    repeated rows are kept, one result per input row; other columns are not read.
    Runs of spaces are kept as they are; a literal U+2581 decodes to a space, as
    in every SentencePiece model.
    """
    kept = [c for c in keep if c != id_col]
    kinds = [docs.schema[c] for c in (id_col, *kept)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), "n_ids long, ids array<int>, decoded string"])
    names = [id_col, *kept, "n_ids", "ids", "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = once_per_worker(f"pieces:{model_path}", lambda: Transducer.load(model_path))
        try:
            for whole in batches:
                for at in range(0, len(whole), 2000):
                    batch = whole.slice(at, 2000)
                    ids = [machine.encode(t.as_py()) for t in batch.column(len(kinds))]
                    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
                    flat = np.concatenate(ids) if ids else np.zeros(0, dtype="<i4")
                    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                    decoded = pa.array([machine.decode(x.tolist()) for x in ids], pa.string())
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns[:len(kinds)], pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), decoded], names)
        finally:
            machine.rest()

    # the text travels under a name of its own: ``keep`` may hold a column of the same name
    return docs.select(id_col, *kept, docs[text_col].alias("__text")).mapInArrow(run, schema)
