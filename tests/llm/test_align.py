import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest

from panelmart.llm import align as A
from support import rows

COLS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PATHS = (P.path(A.A_FILE), P.path(A.B_FILE))


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def brute(table, tokenizers):
    """Every row by the plain libraries: offsets, groups, and links counted in a dictionary."""
    a_lib, b_lib = tokenizers
    alphabet = A._byte_of_char()
    docs, counts = [], Counter()
    for key, text in table:
        found = None
        if text:
            data = (" " + text).encode()
            a = [(i, bytes(alphabet[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(b_lib.id_to_piece(i)[3:-1], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode())
                 for i in b_lib.encode(text)]
            if b"".join(t for _, t in a) == data == b"".join(t for _, t in b):
                ends = [{int(e): i for (i, _), e in zip(x, np.cumsum([len(t) for _, t in x]))} for x in (a, b)]
                cuts = sorted(set(ends[0]) & set(ends[1]))
                groups = ";".join("|".join(",".join(str(i) for e, i in sorted(x.items()) if lo < e <= hi) for x in ends)
                                  for lo, hi in zip([0, *cuts], cuts)) if len(data) < 5000 else None
                links = [(ends[0][c], ends[1][c]) for c in cuts]
                counts.update(links)
                found = len(a), len(b), links, groups
        docs.append((key, found))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for key, found in docs:
        if found is None:
            out.append((key, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, links, groups = found
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups is not None else None
        out.append((key, n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return out


def order(table):
    return sorted(table, key=lambda t: tuple((x is None, str(x)) for x in t[:7]))


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(order(got), order(want)):
        assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7])


def test_matches_the_libraries_on_the_table(spark, tokenizers):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    same(rows(A.align(docs, *PATHS), COLS), brute(table, tokenizers))


def test_odd_rows_and_empty_table(spark, odd_docs, tokenizers):
    table = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    same(rows(A.align(odd_docs, *PATHS), COLS), brute(table, tokenizers))
    assert A.align(odd_docs.limit(0), *PATHS).count() == 0


def test_special_strings_and_differing_bytes(docs_of, tokenizers):
    texts = ["a <|endoftext|> b", "<s> </s> <0x41>", "a▁b", "a\x00b", " two  spaces ", "\n\nx\r\t", "naïve 中文 😀"]
    got = rows(A.align(docs_of(texts), *PATHS), COLS)
    same(got, brute(list(enumerate(texts)), tokenizers))
    assert got[2][1:] == (0, 0, 0, 0, 0, 0, "")


def test_long_texts_as_pieces(docs_of, tokenizers):
    """Pieces of 40 characters over several levels give what whole texts give; one bad piece empties its document."""
    rng = random.Random(2)
    some = ["alpha", "naïve", "中文", "x" * 50, "  ", "don't", "\n\n", "end.", "😀", "1234567"]
    texts = [" ".join(rng.choice(some) for _ in range(300)) for _ in range(6)]
    texts += [texts[0] + " a▁b " + texts[1], "short", texts[0]]
    docs = docs_of(texts)
    small = rows(A.align(docs, *PATHS, piece=40), COLS)
    same(small, brute(list(enumerate(texts)), tokenizers))
    assert small == rows(A.align(docs, *PATHS), COLS)


def test_compose_is_associative_for_any_ranges():
    rng = random.Random(4)
    for _ in range(200):
        n = rng.randrange(1, 60)
        ends = [np.array(sorted({*rng.sample(range(1, n + 1), rng.randrange(n) + 1), n})) for _ in range(2)]
        ids = [np.arange(len(e)) + 100 * k for k, e in enumerate(ends)]
        whole = A.lift(ids[0], ends[0], ids[1], ends[1])
        borders = sorted(rng.sample(range(n + 1), rng.randrange(min(n, 8)) + 1))
        borders = [0, *borders, n]
        parts = []
        for lo, hi in zip(borders, borders[1:]):
            inside = [(e > lo) & (e <= hi) for e in ends]
            parts.append(A.lift(ids[0][inside[0]], ends[0][inside[0]], ids[1][inside[1]], ends[1][inside[1]]))
        left = A.Fragment()
        for p in parts:
            left = A.compose(left, p)
        right = A.Fragment()
        for p in reversed(parts):
            right = A.compose(p, right)
        assert whole == left == right == A.reduce_tree(parts)
        assert not whole.tail_a and A.groups_text(whole).count("|") == whole.n_groups


def test_pairs_stay_below_their_bound(tokenizers):
    assert A.Pair(*PATHS).pair_bound() < 1_000_000
