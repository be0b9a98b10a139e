import random

import numpy as np
import pytest

from panelmart.llm import substring as S


def brute(rows, width):
    first = {}
    for i, t in rows:
        w = (t or "").encode().split()
        for s in range(len(w) - width + 1):
            if i is not None:
                key = tuple(w[s:s + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = (t or "").encode().split()
        gone = np.zeros(len(w), dtype=bool)
        for s in range(len(w) - width + 1):
            if i is not None and first[tuple(w[s:s + width])] < i:
                gone[s:s + width] = True
        out.append((i, len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def solve(frame, **options):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in S.remove_repeats(frame, **options).collect()), key=str)


@pytest.mark.parametrize("group_words", [400_000, 2_000])  # 2,000: most groups take the longest prefix
def test_whole_table(spark, group_words):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert solve(docs, group_words=group_words) == brute([(r.doc_id, r.text) for r in docs.collect()], 50)


@pytest.mark.parametrize("width,anchor", [(8, 3), (13, 5), (20, 7)])
def test_two_letter_texts(docs_of, width, anchor):
    rng = random.Random(width)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 120))) for _ in range(80)]
    texts += ["x " * 400, "x " * 300, "x " * (width - 1), "x " * width, None]
    frame = docs_of(texts)
    assert solve(frame, min_words=width, anchor=anchor, group_words=500) == brute(list(enumerate(texts)), width)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert solve(odd_docs) == brute(rows, 50)
    assert solve(odd_docs.limit(0)) == []


def test_repeated_and_nameless_rows(docs_of, words):
    passage = words(60, seed=5)
    rows = [(3, passage), (3, passage), (None, passage), (4, "head " + passage + " tail"), (2, words(70, seed=6))]
    frame = docs_of([t for _, t in rows], [i for i, _ in rows])
    got = solve(frame)
    assert got == brute(rows, 50)
    assert (4, 62, 60, "head tail") in got
