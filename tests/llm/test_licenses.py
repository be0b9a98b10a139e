import random

import pytest

from panelmart.llm import licenses as L


def brute_words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if "A" <= c <= "Z":
            c = c.lower()
        if c >= "\x80" or c.isascii() and c.isalnum():
            word += c
        else:
            out += [word] if word else []
            word = ""
    return out


def brute_base(text):
    words = brute_words(text)
    places = [(i, label) for phrase, label in L.PHRASES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), len(places), min([p for p, _ in places], default=None), max([p for p, _ in places], default=None), ",".join(sorted({x for _, x in places}))


@pytest.fixture(scope="module")
def search():
    return L.NoticeSearch(L.PHRASES, L.NOTICES, L.EDIT_SHARE)


def test_base_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = L.scan_licenses(docs).collect()
    assert len(rows) == len(text)
    for r in rows:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert any(r.n_base for r in rows)


def test_base_of_random_texts(search):
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice(["MIT", "mit", "License", "apache", "general", "public", " ", "-", "\n", "é", "1"]) + rng.choice(["", " "]) for _ in range(30))
        got = search.scan(text)
        assert got[:5] == brute_base(text), repr(text)


def test_fuzzy_notices_against_plain_search(search):
    """Every notice with edits up to the bound is found, by an exact edit distance."""
    from panelmart.llm.decontam import edit_search

    rng = random.Random(5)
    for label, notice in L.NOTICES:
        k = L.edit_bound(notice)
        for _ in range(6):
            chars = list(notice)
            for _ in range(rng.randint(0, k)):
                at = rng.randrange(len(chars))
                chars[at:at + 1] = rng.choice([[], ["x"], [chars[at], "q"]])
            text = "zzz yyy " * 30 + "".join(chars) + " www vvv" * 30
            norm = " ".join(brute_words(text))
            spans = search.fuzzy(norm)
            assert spans, (notice, "".join(chars))
            near = [s for s in spans if s[0] == label]
            if near:
                best = edit_search([ord(c) for c in notice], [ord(c) for c in norm])[0]
                assert best <= min(s[3] for s in near) <= k


def test_spans_and_scores(search):
    text = "Words before. Licensed under CC BY-NC 4.0, and relaesed under the MIT Licence here."
    n, base, first, last, base_labels, labels, score, spans = search.scan(text)
    assert (base, base_labels, labels) == (0, "", "cc-by-nc,mit")
    words = brute_words(text)
    for s in spans:
        assert " ".join(words[s["first_word"]:s["first_word"] + s["n_words"]]).startswith(s["span"][:6])
    assert score == 1.0 and {s["edits"] for s in spans} == {0, 3}


def test_clean_text_has_no_label(search):
    assert search.scan("the story is free of all charge to any person in the public domain of words")[5] == ""


def test_odd_rows(odd_docs):
    rows = L.scan_licenses(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all((r.n_words, r.n_base, r.first_word, r.labels, r.score) == (0, 0, None, "", 0.0) for r in rows if r.doc_id in (0, 1, 2))
    assert L.scan_licenses(odd_docs.limit(0)).count() == 0
