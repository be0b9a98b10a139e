import random

import pytest
import sentencepiece

from panelmart.llm import spm as P
from panelmart.llm.queries import tokenizer_file

BITS = [" " * 37, "ሀሁ", "a", "b", "the ", "  ", "   ", " ", "\n", "\t", "é", "ﬁ", "ｆ", ".com", "http://", "1", "234", "!", "😀", "x" * 40, "中", "́", "<s>",
        "</s>", "<unk>", "<0x0A>", "'s", "▁", "m²", "².", "².a", ",b\n", "_x1", "1²"]


@pytest.fixture(scope="module")
def machine():
    return P.Transducer.load(tokenizer_file(P.MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(P.MODEL))


def test_random_texts_match_library(machine, library):
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))
        ids = library.encode(text)
        assert machine.encode(text).tolist() == ids, repr(text)
        assert machine.decode(ids) == library.decode(ids), repr(text)


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = P.encode_documents(docs, tokenizer_file(P.MODEL), keep=("lang",)).collect()
    assert len(rows) == len(text)
    for r in rows:
        assert r.ids == library.encode(text[r.doc_id]) and r.n_ids == len(r.ids) and r.decoded == text[r.doc_id]


def test_unigram_lattice_is_viterbi():
    """Without merge constraints the shortest path is the cheapest of all segmentations."""
    pieces = [("<unk>", 0.0), ("a", -1.0), ("b", -1.5), ("ab", -2.0), ("ba", -2.2), ("aba", -2.9), ("▁", -0.5), ("▁a", -1.2)]
    machine = P.Transducer(pieces, set(), {}, 0, merges=False)

    def cheapest(text):
        best = {0: (0.0, [])}
        for i in range(1, len(text) + 1):
            options = [(best[j][0] + machine.cost[machine.lexicon[text[j:i]]], best[j][1] + [machine.lexicon[text[j:i]]])
                       for j in range(i) if j in best and text[j:i] in machine.lexicon]
            if options:
                best[i] = min(options)
        return best[len(text)][0]

    rng = random.Random(2)
    for _ in range(200):
        unit = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        assert abs(sum(machine.cost[i] for i in machine.shortest(unit)) - cheapest(unit)) < 1e-9


def test_constrained_path_is_the_merge_result(machine):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for _ in range(500):
        unit = "▁" + "".join(rng.choice(letters) for _ in range(rng.randint(1, 20)))
        assert machine.only_path(unit) == machine.merged(unit)


def test_odd_rows(odd_docs, library):
    rows = P.encode_documents(odd_docs, tokenizer_file(P.MODEL), keep=("text", "label")).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.ids == library.encode(r.text or "") and r.decoded == library.decode(r.ids) and r.label == "extra label"
    assert P.encode_documents(odd_docs.limit(0), tokenizer_file(P.MODEL)).count() == 0


def test_memo_stays_bounded(machine):
    from panelmart.llm.common import Memo

    memo = Memo(10)
    for i in range(100):
        for key in memo.missing([f"k{i}", "often"]):
            memo.now[key] = key
        assert memo.now["often"] == "often" and len(memo.now) <= 11 and len(memo.old) <= 11


def test_a_worker_holds_little_after_a_task(spark, docs_of):
    texts = [" ".join(f"{chr(97 + a)}{chr(97 + b)}{chr(97 + c)}{chr(97 + d)}" for c in range(26) for d in range(26)) for a in range(8) for b in range(10)]
    got = P.encode_documents(docs_of(texts).coalesce(1), tokenizer_file(P.MODEL))
    assert all(r.decoded == texts[r.doc_id] for r in got.collect())

    def held(batches):
        import pyarrow as pa
        import pyspark

        for _ in batches:
            machines = [m for k, m in pyspark.__dict__.get("_panelmart_worker", {}).items() if k.startswith("pieces:")]
            yield pa.RecordBatch.from_arrays([pa.array([len(m.paths.now) + len(m.paths.old) for m in machines], pa.int64())], ["n"])

    sizes = [r.n for r in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()]
    assert 0 < max(sizes) <= P.HELD    # 54,080 units were learned


def test_paths_are_the_same_after_a_rest():
    machine = P.Transducer.load(tokenizer_file(P.MODEL))
    texts = [f"word{i} other{i % 7} Ünïcode  x\n{i}" for i in range(200)]
    before = [machine.encode(t).tolist() for t in texts]
    machine.rest()
    assert machine.paths.old == {} and [machine.encode(t).tolist() for t in texts] == before
