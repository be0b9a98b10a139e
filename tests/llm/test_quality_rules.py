import random
from collections import Counter

from panelmart.llm import quality as Q


def brute_base(text):
    text = text or ""
    spaces = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for c in text + " ":
        if c in spaces:
            words += [word] if word else []
            word = ""
        else:
            word += c
    lines, dups = set(), 0
    for line in text.split("\n"):
        if line.strip(spaces):
            dups += line in lines
            lines.add(line)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(covered)]


def test_base_counts_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = Q.judge(docs).collect()
    assert len(rows) == len(text)
    for r in rows:
        want = brute_base(text[r.doc_id])
        assert [r[c] for c in Q.BASE] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)


def test_base_counts_of_random_texts():
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice(["a", "b", "é", "#", "|", " ", "  ", "\n", "\t", "中", "\x1c", " "]) for _ in range(rng.randint(0, 80)))
        assert Q.count_text(text, [])[:5] == brute_base(text), repr(text)


def test_labels(spark):
    """Held-out labels: documents labelled good stay, most junk goes."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = Q.judge(docs).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    junk = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.995 * len(good) and sum(junk) <= 0.25 * len(junk)


def test_filter_agrees_with_judge(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert {r.doc_id for r in Q.judge(docs).where("kept").collect()} == {r.doc_id for r in Q.keep_good(docs).collect()}


def test_js_distance_of_plan_and_task(spark):
    from pyspark.sql import functions as F

    counts, shares = [3, 0, 5, 2], [0.25, 0.25, 0.5, 0.0]
    row = spark.range(1).select(Q._js_distance(F.array(*map(F.lit, counts)), F.array(*map(F.lit, shares))).alias("d")).first()
    import numpy as np
    assert abs(row.d - Q.js_distance(counts, np.array(shares))) < 1e-12
    assert Q.js_distance([1, 1], np.array([0.5, 0.5])) == 0 and abs(Q.js_distance([1, 0], np.array([0.0, 1.0])) - 1) < 1e-12


def test_odd_rows(odd_docs):
    from pyspark.sql import functions as F

    rows = Q.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = [r for r in rows if r.doc_id in (0, 1, 2)]
    assert all(r.n_words == 0 and r.base_failed and not r.kept and r.char_distance >= 0 for r in empty)
    nameless = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert Q.judge(nameless).count() == odd_docs.count()
    kept = Q.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Q.judge(odd_docs.limit(0)).count() == 0 and Q.keep_good(odd_docs.limit(0)).count() == 0


def _prose(rng, words, n=60):
    return " ".join(rng.choice(words) for _ in range(n)) + "."


def test_unlisted_languages_stay(spark):
    """Clean documents of languages without a reference are judged by the base rules alone."""
    rng = random.Random(5)
    italian = [f"{a}{b}" for a in ("par", "cant", "bel", "gatt", "tavol", "strad") for b in ("o", "a", "i", "ando", "ezza", "ità")]
    chinese = [a + b for a in "天地人山水火风云日月" for b in "大小上下左右中来去好"]
    rows = [(i, _prose(rng, italian), "it") for i in range(100)] + [(100 + i, _prose(rng, chinese), "zh") for i in range(100)]
    rows += [(200, "one two", "it"), (201, "the same five words here " * 30, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in Q.judge(docs).where("kept").collect()}
    assert kept == set(range(200)) == {r.doc_id for r in Q.keep_good(docs).collect()}


def test_a_source_of_tables_moves_no_reference(spark):
    """Prose stays, tables go, though long tables are a third of the rows and most characters."""
    rng = random.Random(6)
    common, others = Q.COMMON_WORDS["en"], [f"{a}{b}" for a in ("mar", "ten", "sol", "riv", "hous") for b in ("ing", "er", "ed", "ly", "ation")]
    zipf = [1 / (i + 1) for i in range(len(common))]
    word = lambda: rng.choices(common, zipf)[0] if rng.random() < 0.35 else rng.choice(others)
    rows = [(i, " ".join(word() for _ in range(200)) + ".", "en") for i in range(200)]
    rows += [(200 + i, " ".join(f"|{rng.randrange(10**6)}|" for _ in range(400)), "en") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in Q.judge(docs).where("kept").collect()}
    assert kept == set(range(200)) == {r.doc_id for r in Q.keep_good(docs).collect()}
