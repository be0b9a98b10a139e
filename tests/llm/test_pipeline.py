import re

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from panelmart.llm import decontam, quality, simhash, spm  # noqa: E402
from panelmart.llm.queries import QUERIES, tokenizer_file  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_stages_and_result(spark):
    """Every stage works on what the one before it kept, and its decisions take effect."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "simhash_dedup", "decontamination", "pii_surrogates", "sentencepiece"]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(corpus_pipeline.scratch(stage(spark, kept[-1], SF), "test-stage"))
    assert all(k.columns == docs.columns for k in kept[1:-1])
    ids = [{r.doc_id for r in k.select("doc_id").collect()} for k in kept]
    assert ids[1] == {r.doc_id for r in quality.judge(docs).where("kept").collect()}
    groups = simhash.near_duplicates(kept[1]).collect()
    assert ids[2] == {r.component_id for r in groups}
    leaks = {r.doc_id for r in decontam.find_leaks(kept[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert leaks and ids[3] == ids[2] - leaks
    assert ids[4] == ids[3] == ids[5]
    texts = {r.doc_id: r for r in kept[4].collect()}
    assert not any(re.search(r"@mail\d\.example\.com", r.text) for r in texts.values())
    assert all(r.n_chars == len(r.text) for r in texts.values())
    library = spm.Transducer.load(tokenizer_file(spm.MODEL))
    for r in kept[5].collect():
        assert r.decoded == texts[r.doc_id].text and r.ids == library.encode(texts[r.doc_id].text).tolist()
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).select("doc_id").collect()) == sorted(ids[5])


def test_odd_rows(spark, odd_docs):
    for _, stage in corpus_pipeline.STAGES:
        for docs in (odd_docs, odd_docs.limit(0)):
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count()
            if stage is not corpus_pipeline.STAGES[-1][1]:
                assert out.columns == docs.columns


def test_names_of_extra_columns(spark, odd_docs):
    """Extra columns with dots, back quotes or names of inner columns pass through with their values."""
    from pyspark.sql import functions as F

    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars", F.lit(7).alias("meta.x"), F.lit("q").alias("a`b"), F.lit(1).alias("text_key"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert all((r["meta.x"], r["a`b"], r["text_key"]) == (7, "q", 1) for r in out.collect())
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_defined_results_of_odd_rows(spark, odd_docs):
    """Quality: texts of fewer than 10 words or of repeats go. Dedup: one row of equal ones stays."""
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.text for r in stages["quality_rules"](spark, odd_docs, SF).collect()}
    assert texts <= {r.text for r in odd_docs.collect()} and all(len((t or "").split()) >= 10 for t in texts)
    left = stages["simhash_dedup"](spark, odd_docs, SF).collect()
    assert len({(r.doc_id, r.text) for r in left}) == len(left)
    assert sum((r.text or "").split() == ["word"] for r in left) == 1
    assert sum(not (r.text or "").split() for r in left) == 1
    clean = stages["decontamination"](spark, odd_docs, SF)
    assert clean.count() == odd_docs.count()
    out = stages["pii_surrogates"](spark, odd_docs, SF).collect()
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.text or "") for r in out) == sorted(
        ((r.doc_id is None, r.doc_id or 0), r.text or "") for r in odd_docs.collect())


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
