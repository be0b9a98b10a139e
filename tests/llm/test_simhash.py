import random

import numpy as np
import xxhash

from panelmart.llm import simhash as S
from panelmart.llm.graph import components


def brute_fingerprint(text, width=3):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, bits=3):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                parent[find(i)] = find(j)
    out = {}
    for i, x in enumerate(ids):
        root = find(i)
        known = [y for k, y in enumerate(ids) if y is not None and find(k) == root]
        out[i] = min(known, default=None)
    return [out[i] for i in range(len(ids))]


def test_components_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    want = dict(zip([r.doc_id for r in rows], zip((f"{p:016x}" for p in prints), brute_components([r.doc_id for r in rows], prints))))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()}
    assert got == want


def test_cells_lose_no_pair_within_the_bits():
    rng = random.Random(1)
    masks = [m & (1 << 64) - 1 for m in S.cell_masks()]
    for _ in range(500):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        odd = 0x5555555555555555
        unary = lambda x: ((x | x >> 1) & odd) | ((x & x >> 1) & odd) << 1
        assert bin(unary(a) ^ unary(b)).count("1") <= 3
        assert any(unary(a) & m == unary(b) & m for m in masks)


def test_embedding_counts_bits(spark):
    from pyspark.sql import functions as F

    values = [0, -1, 5, 6, 2**62 + 3, -(2**63)]
    rows = spark.createDataFrame([(v,) for v in values], "fp long").select(S.embed(F.col("fp")).alias("e")).collect()
    for v, r in zip(values, rows):
        for s in range(32):
            count = bin(v >> 2 * s & 3).count("1")
            assert r.e >> 2 * s & 3 == (0, 1, 3)[count]


def test_hot_cells_in_blocks(spark):
    """A dense family of near copies, dealt out in tiny blocks, gives the same links."""
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    family = {centre}
    while len(family) < 120:
        x = rng.choice(sorted(family))
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            x ^= 1 << bit
        family.add(x)
    prints = sorted(family)
    frame = spark.createDataFrame([(S._signed(p),) for p in prints], "fp long")
    links = S.near_links(frame, block=8)
    assert links.count() < 20 * 120 * 120
    found = {r.node: r.component for r in components(links).collect()}
    label = [found.get(S._signed(p), S._signed(p)) for p in prints]
    brute = brute_components(list(range(len(prints))), prints)
    for i in range(len(prints)):
        for j in range(len(prints)):
            assert (label[i] == label[j]) == (brute[i] == brute[j])


def test_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_odd_rows(odd_docs):
    rows = S.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    # null, empty and blank text: fingerprint zero, one component
    zero = [r for r in rows if r.doc_id in (0, 1, 2)]
    assert {r.fingerprint for r in zero} == {"0" * 16} and {r.component_id for r in zero} == {0}
    kept = S.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and None not in ids and 0 in ids
    assert S.near_duplicates(odd_docs.limit(0)).count() == 0 and S.keep_one(odd_docs.limit(0)).count() == 0


def test_rows_without_id(docs_of):
    docs = docs_of(["a b c d e", "a b c d e", "quite another text here"], [None, None, 7])
    kept = S.keep_one(docs).collect()
    assert sorted((r.doc_id is None, r.text) for r in kept) == [(False, "quite another text here"), (True, "a b c d e")]


def test_fingerprint_is_blockwise_exact():
    text = " ".join(f"t{i % 977}" for i in range(70_000))
    assert np.uint64(brute_fingerprint(text)) == np.int64(S.fingerprint(text)).view(np.uint64)


def test_repeated_ids_of_different_groups(docs_of, words):
    """An id repeated with different texts: every group keeps one row."""
    x, y, z = (words(60, seed=s) for s in (1, 2, 3))
    kept = S.keep_one(docs_of([x, y, y, z, z], [5, 5, 3, 5, 5])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(5, x), (3, y), (5, z)])


def test_near_copies_without_id(docs_of, words):
    """Rows without an id in one component, of different fingerprints or texts: one stays."""
    text = words(400, seed=5)
    far = lambda t: bin((S.fingerprint(t) ^ S.fingerprint(text)) & (1 << 64) - 1).count("1")
    near = next(t for t in (f"{text} end{i}" for i in range(1000)) if 1 <= far(t) <= 3)
    kept = S.keep_one(docs_of([text, near, "A  b", "a b"], [None] * 4)).collect()
    assert len(kept) == 2
