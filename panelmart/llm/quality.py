"""Quality rules by distribution divergence.

Every document gets two histograms: its character classes and its language's
common words (plus one bin for all other words).  A language's reference holds the
median share of every bin over its documents that pass the base rules and are long
enough to be judged, each document once: neither long texts nor a source below half of
them moves it.  A document whose Jensen-Shannon distance from its language's reference
exceeds a limit is rejected; documents too short for a histogram to mean anything are
guarded by minimum lengths, and both limits fall with the length since the sampling
error of a histogram falls with its size.  Languages without a list of common words
have no reference: the base rules alone judge them.

One pass over the text (Arrow batches) makes the counts, which are written to
the shared folder; references and distances are plain aggregates and column
expressions over that narrow table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmart.llm.common import scratch

# Common words of each language, the bins of its word histogram.
COMMON_WORDS = {
    "en": "the of and to a in is that it for was on with as be by this are at from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im nicht dem ein eine als".split(),
    "fr": "de la le et les des en un du une que pour est par qui dans avec sur pas au".split(),
    "es": "de la que el en y los se del las un por con no su una para es al lo".split(),
}
N_COMMON = 20
STEPS = 1000                           # medians are taken over shares in steps of 1 / STEPS
CHAR_CLASSES = ("lower", "upper", "digit", "space", "symbol", "other_ascii", "non_ascii")
MIN_CHARS, MIN_WORDS = 80, 30          # below: the histogram is not judged
CHAR_LIMIT, CHAR_SLACK = 0.12, 1.5     # limit of the class distance: CHAR_LIMIT + CHAR_SLACK / sqrt(words)
WORD_LIMIT, WORD_SLACK = 0.2, 1.2      # limit of the word distance, likewise

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"

_BYTE_CLASS = np.full(256, 5)
_BYTE_CLASS[97:123] = 0
_BYTE_CLASS[65:91] = 1
_BYTE_CLASS[48:58] = 2
_BYTE_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_BYTE_CLASS[list(SYMBOLS)] = 4
_BYTE_CLASS[128:192] = 7               # continuation bytes: no code point of their own
_BYTE_CLASS[192:] = 6

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xA0761D6478BD642F], dtype=np.uint64)


def _mixed(ids: np.ndarray) -> np.ndarray:
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def repeated_words(ids: np.ndarray, width: int = 5) -> int:
    """Words covered by a ``width``-word window found twice or more (all its places)."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    x = _mixed(ids)
    key = sum((x[i:i + n] * _MIX[i] for i in range(width)), np.zeros(n, dtype=np.uint64))
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    start = (counts[inverse] > 1).astype(np.int64)
    edge = np.zeros(len(ids) + 1, dtype=np.int64)
    edge[:n] += start
    edge[width:width + n] -= start
    return int((np.cumsum(edge) > 0).sum())


def _forms(words: list[str]) -> list[tuple[bytes, int]]:
    """Written forms of the common words (either case, with closing punctuation)."""
    return [((w + end).encode(), i) for i, word in enumerate(words)
            for w in dict.fromkeys((word, word.capitalize())) for end in ("", ".", ",", ";", ":", "!", "?")]


def count_text(text: str | None, forms: list[tuple[bytes, int]]) -> list:
    """Base counts, then the character-class and common-word histograms."""
    data = (text or "").encode()
    hist = np.bincount(_BYTE_CLASS[np.frombuffer(data, dtype=np.uint8)], minlength=8)[:7]
    words = data.split()
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), dtype=np.int64, count=len(words))
    seen: set[bytes] = set()
    dups = 0
    for line in data.split(b"\n"):
        if line in seen:
            dups += 1
        elif line and not line.isspace():
            seen.add(line)
    common = np.zeros(N_COMMON + 1, dtype=np.int64)
    if words:
        freq = np.bincount(ids)
        for form, i in forms:
            at = index.get(form)
            if at is not None:
                common[i] += freq[at]
        common[N_COMMON] = len(words) - common.sum()
    return [len(words), int(hist.sum() - hist[3]), int(hist[4]), dups, repeated_words(ids),
            hist.tolist(), common.tolist()]


def js_distance(counts: list, shares: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) between a count histogram and reference shares."""
    p = np.asarray(counts, dtype=float)
    if not p.sum():
        return 0.0
    p = p / p.sum()
    middle = (p + shares) / 2
    terms = [x[x > 0] * np.log2(x[x > 0] / middle[x > 0]) for x in (p, shares)]
    return float(np.sqrt(max(0.0, (terms[0].sum() + terms[1].sum()) / 2)))


def verdict(counted: list, reference: tuple[np.ndarray, np.ndarray] | None,
            char_limit: float = CHAR_LIMIT, word_limit: float = WORD_LIMIT) -> bool:
    """Whether a counted text stays, by the base rules and the distances."""
    n, repeated, chars, common = counted[0], counted[4], counted[5], counted[6]
    if n < 10 or 100 * repeated > 20 * n:
        return False
    if reference is None:
        return True
    slack = 1 / np.sqrt(n)
    if sum(chars) >= MIN_CHARS and js_distance(chars, reference[0]) > char_limit + CHAR_SLACK * slack:
        return False
    return n < MIN_WORDS or js_distance(common, reference[1]) <= word_limit + WORD_SLACK * slack


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            common_words: dict[str, list[str]] = COMMON_WORDS) -> DataFrame:
    """``id_col``, text key, language, base counts and both histograms of every row."""
    schema = (f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, text_key long, language string, "
              + ", ".join(f"{c} long" for c in BASE) + ", chars array<long>, common array<long>")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = {lang: _forms(ws) for lang, ws in common_words.items()}
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
        for batch in batches:
            langs = [x if x in forms else "" for x in batch.column(3).to_pylist()]
            out = [count_text(t.as_py(), forms.get(g, [])) for t, g in zip(batch.column(2), langs)]
            cols = [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(langs, pa.string()), *cols],
                                             [id_col, "text_key", "language", *BASE, "chars", "common"])

    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col), key.alias("text_key"), F.col(text_col),
                       F.col(lang_col).cast("string").alias("__lang")).mapInArrow(run, schema)


def _base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def references(counts: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Shares of both histograms of every listed language, by the lower median of each bin.

    Shares in steps of ``1 / STEPS`` are counted (at most STEPS + 1 values a bin, summed
    map-side), so a median is exact and no task holds a language's documents.  One row a
    language and bin comes to the driver.  A language without a judged document has none.
    """
    def steps(hist: Column) -> Column:
        total = F.aggregate(hist, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.transform(hist, lambda x: F.floor(STEPS * (x.cast("double") / total) + 0.5).cast("int"))

    n_chars = F.aggregate(F.col("chars"), F.lit(0).cast("long"), lambda a, x: a + x)
    judged = counts.where((F.col("language") != "") & ~_base_failed() & (F.col("n_words") >= MIN_WORDS) & (n_chars >= MIN_CHARS))
    values = judged.select("language", F.posexplode(F.concat(steps(F.col("chars")), steps(F.col("common")))).alias("bin", "value"))
    values = values.groupBy("language", "bin", "value").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("language", "bin")
    reached = F.sum("n").over(whole.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    middle = values.withColumns({"reached": reached, "all": F.sum("n").over(whole)}).where(2 * F.col("reached") >= F.col("all"))
    found: dict[str, list[int]] = {}
    for row in middle.groupBy("language", "bin").agg(F.min("value").alias("value")).collect():
        found.setdefault(row.language, [0] * (len(CHAR_CLASSES) + N_COMMON + 1))[row.bin] = row.value
    out = {}
    for lang, medians in found.items():
        parts = medians[:len(CHAR_CLASSES)], medians[len(CHAR_CLASSES):]
        if all(map(sum, parts)):
            out[lang] = tuple([x / sum(p) for x in p] for p in parts)
    return out


def _js_distance(hist: Column, ref: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) between a count array and shares."""
    total = F.aggregate(hist, F.lit(0.0), lambda a, x: a + x.cast("double"))
    share = F.transform(hist, lambda x: x.cast("double") / total)

    def half(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))

    terms = F.zip_with(share, ref, lambda p, q: half(p, q) + half(q, p))
    value = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.when(total > 0, F.sqrt(F.greatest(value, F.lit(0.0)))).otherwise(F.lit(0.0))


def _by_language(refs: dict[str, tuple[list[float], list[float]]], part: int) -> Column:
    out = F.lit(None).cast("array<double>")
    for lang, pair in refs.items():
        out = F.when(F.col("language") == lang, F.array(*map(F.lit, pair[part]))).otherwise(out)
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          common_words: dict[str, list[str]] = COMMON_WORDS, char_limit: float = CHAR_LIMIT,
          word_limit: float = WORD_LIMIT) -> DataFrame:
    """Base counts, distances and verdict of every document.

    Returns ``id_col``, text_key, the base counts, char_distance, word_distance,
    base_failed (fewer than 10 words, or over 20 % of the words in repeated
    5-word windows) and kept.  Null or empty text: all counts 0, distances 0, base
    failed.  A null or unlisted language has no reference: distances 0, judged by the base
    rules alone; so is a listed one none of whose documents is long enough.  One
    result per input row, repeated rows and null ids included; an empty table gives
    an empty result; other columns are not read.
    """
    counts = scratch(measure(docs, id_col, text_col, lang_col, common_words), "quality-counts")
    refs = references(counts)
    n = F.col("n_words")
    known = F.col("language").isin(*refs)
    distance = lambda hist, part: F.when(known, _js_distance(F.col(hist), _by_language(refs, part))).otherwise(0.0)
    measured = counts.withColumns({
        "char_distance": distance("chars", 0), "word_distance": distance("common", 1),
        "n_chars": F.aggregate(F.col("chars"), F.lit(0).cast("long"), lambda a, x: a + x),
    })
    base_failed = _base_failed()
    odd_chars = (F.col("n_chars") >= MIN_CHARS) & (
        F.col("char_distance") > char_limit + CHAR_SLACK / F.sqrt(F.greatest(n, F.lit(1)).cast("double")))
    odd_words = (n >= MIN_WORDS) & (F.col("word_distance") > word_limit + WORD_SLACK / F.sqrt(F.greatest(n, F.lit(1)).cast("double")))
    return measured.select(id_col, "text_key", *BASE, "char_distance", "word_distance",
                           base_failed.alias("base_failed"), (~base_failed & ~odd_chars & ~odd_words).alias("kept"))


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
              common_words: dict[str, list[str]] = COMMON_WORDS) -> DataFrame:
    """The rows of ``docs`` (all columns) that ``judge`` keeps; same rules.

    The verdict is recomputed beside the text once the references are known (a
    second pass over the text), so no row is shuffled or joined.
    """
    at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)
    id_free = docs.select(F.lit(0).alias("__row"), F.col(text_col), F.col(lang_col))
    refs = {lang: tuple(map(np.array, pair))
            for lang, pair in references(measure(id_free, "__row", text_col, lang_col, common_words)).items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = {lang: _forms(ws) for lang, ws in common_words.items()}
        for batch in batches:
            langs = [x if x in forms else "" for x in batch.column(lang_at).to_pylist()]
            keep = [verdict(count_text(t.as_py(), forms.get(g, [])), refs.get(g)) for t, g in zip(batch.column(at), langs)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
