import random

import pytest

from panelmart.llm import decontam as D


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best_stretch(pattern, text):
    """Least edit distance of the pattern to any stretch of the text (plain dynamic programme)."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_edit_search_matches_plain():
    rng = random.Random(0)
    for _ in range(400):
        pattern = [rng.randrange(4) for _ in range(rng.randint(1, 70))]
        text = [rng.randrange(4) for _ in range(rng.randint(0, 90))]
        edits, end = D.edit_search(pattern, text)
        assert edits == best_stretch(pattern, text)
        assert min(distance(pattern, text[a:end]) for a in range(end + 1)) == edits


def edited(words, edits, rng, vocabulary):
    words = list(words)
    for _ in range(edits):
        kind, at = rng.random(), rng.randrange(len(words))
        if kind < 0.4:
            words[at] = rng.choice(vocabulary)
        elif kind < 0.7:
            del words[at]
        else:
            words.insert(at, rng.choice(vocabulary))
    return words


@pytest.mark.parametrize("share,least", [(0.0, 1.0), (0.1, 0.97), (0.2, 0.93)])
def test_recall_against_brute_force(share, least):
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)] + ["the", "of", "and"] * 300
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(12, 60))] for _ in range(60)]
    matcher = D.Matcher([(i, " ".join(w)) for i, w in enumerate(items)])
    texts, planted = [], set()
    for k in range(150):
        i = rng.randrange(len(items))
        body = edited(items[i], int(share * len(items[i])), rng, vocabulary)
        texts.append(" ".join([rng.choice(vocabulary) for _ in range(rng.randint(0, 40))] + body + [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]))
        planted.add((k, i))
    found = {(r, i): e for r, i, e, _, _ in matcher.search(texts)}
    assert len(planted & found.keys()) >= least * len(planted)
    for (r, i), e in found.items():  # no false match, and the edits are exact
        assert e == best_stretch(items[i], texts[r].split()) <= int(0.2 * len(items[i]))


def test_given_tables_exact_leaks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    norm = lambda t: b" " + b" ".join(D.words_of(t)) + b" "
    texts = [(r.doc_id, norm(r.text)) for r in docs.collect()]
    want = {(d, r.item_id) for r in items.collect() for d, t in texts if norm(r.text) in t}
    got = {(r.doc_id, r.item_id): r for r in D.find_leaks(docs, items).collect()}
    assert want <= got.keys() and all(got[k].edits == 0 for k in want)
    kept = {r.doc_id for r in D.drop_leaks(docs, items).collect()}
    assert kept == {d for d, _ in texts} - {d for d, _ in got}


def test_blocks_of_items(spark, docs_of, words, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 3)
    items = spark.createDataFrame([(i, words(30, 500, i)) for i in range(10)], "item_id long, text string")
    docs = docs_of([f"{words(20, 900, 50 + i)} {words(30, 500, i)} tail" for i in range(10)] + [words(80, 900, 99)])
    assert sorted((r.doc_id, r.item_id, r.edits, r.first_word, r.n_words) for r in D.find_leaks(docs, items).collect()) == [
        (i, i, 0, 20, 30) for i in range(10)]
    assert [r.doc_id for r in D.drop_leaks(docs, items).collect()] == [10]


def test_odd_rows(spark, odd_docs, words):
    items = spark.createDataFrame([(1, words(20)), (None, words(25, 200, 3)), (2, None), (3, ""), (4, "too short"), (1, words(20))],
                                  "item_id long, text string")
    assert D.find_leaks(odd_docs, items).count() == 0
    kept = D.drop_leaks(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    for a, b in ((odd_docs.limit(0), items), (odd_docs, items.limit(0)), (odd_docs.limit(0), items.limit(0))):
        assert D.find_leaks(a, b).count() == 0 and D.drop_leaks(a, b).count() == a.count()


def test_leak_at_the_ends(spark, docs_of, words):
    item = words(20, 300, 1)
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    docs = docs_of([item, item + " after", "before " + item, " ".join(item.split()[2:]), " ".join(item.split()[:-3])])
    assert sorted((r.doc_id, r.edits) for r in D.find_leaks(docs, items).collect()) == [(0, 0), (1, 0), (2, 0), (3, 2), (4, 3)]


@pytest.mark.parametrize("max_edits", [0.2, 0.3])
def test_short_items_against_brute_force(max_edits):
    """Items below the walks' length are found wherever the edit limit allows, none else."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 7))] for _ in range(60)] + [[f"w{i}" for i in range(9)]]
    texts = [[rng.choice([*vocabulary, "other"]) for _ in range(rng.randint(0, 25))] for _ in range(80)] + items
    matcher = D.Matcher([(i, " ".join(w)) for i, w in enumerate(items)], max_edits)
    found = {(r, i): (e, a, n) for r, i, e, a, n in matcher.search([" ".join(t) for t in texts]) if len(items[i]) < D.MIN_ITEM_WORDS}
    want = {(r, i): e for r, t in enumerate(texts) for i, w in enumerate(items[:-1]) if (e := best_stretch(w, t)) <= int(max_edits * len(w))}
    assert {k: e for k, (e, _, _) in found.items()} == want and len(want) > 500
    assert all(distance(items[i], texts[r][a:a + n]) == e for (r, i), (e, a, n) in found.items())


def test_short_items_of_a_table(spark, docs_of):
    items = spark.createDataFrame([(1, "Who won it?"), (2, "what is the capital of france"), (3, "...")], "item_id long, text string")
    docs = docs_of(["so who won it then", "what is the big capital of France", "who has won it", "capital of France"])
    assert sorted((r.doc_id, r.item_id, r.edits) for r in D.find_leaks(docs, items).collect()) == [(0, 1, 0), (1, 2, 1)]
    assert sorted(r.doc_id for r in D.drop_leaks(docs, items).collect()) == [2, 3]
