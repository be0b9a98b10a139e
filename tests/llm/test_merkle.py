import hashlib
import zlib

from pyspark.sql import functions as F

from panelmart.llm import merkle as M
from panelmart.llm.queries import op12_merkle
from support import rows

COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(r, more=0):
    values = [r["doc_id"], r["source"], r["lang"], None if r["n_chars"] is None else r["n_chars"] + more, r["text"]]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(hashes, fanout=2):
    """(root, the siblings before and after of every node, level by level)."""
    paths, level, places = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(level) > 1:
        for k, p in enumerate(places):
            run = level[p - p % fanout:p - p % fanout + fanout]
            paths[k].append(("".join(run[:p % fanout]), "".join(run[p % fanout + 1:])))
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        places = [p // fanout for p in places]
    return level[0], paths


def brute(table, fanout=2):
    groups = {}
    for r in table:
        groups.setdefault(r["lang"], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    members = {g: sorted(groups[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r))) for g in order}
    trees = {g: climb([leaf(r) for r in members[g]], fanout) for g in order}
    if not order:
        return []
    root, above = climb([trees[g][0] for g in order], fanout)
    out = []
    for g, high in zip(order, above):
        for r, path in zip(members[g], trees[g][1]):
            whole = path + high
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            folded = leaf(r, 1 if tampered else 0)
            for before, after in whole:
                folded = h(before, folded, after)
            out.append((r["doc_id"], leaf(r), trees[g][0], root, h(*(b + a for b, a in whole)), folded, folded == root))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def query(spark, tmp_path, docs):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    return rows(op12_merkle(spark, str(tmp_path)), COLS)


def test_odd_rows_groups_and_nulls(spark, tmp_path, odd_docs):
    lang = F.when(F.col("doc_id") == 1, F.lit(None)).when(F.col("doc_id") == 2, F.lit("")).when(F.col("doc_id") > 3, F.lit("é")).otherwise(F.col("lang"))
    docs = odd_docs.withColumn("lang", lang).withColumn("n_chars", F.when(F.col("doc_id") != 4, F.col("n_chars")))
    table = [r.asDict() for r in docs.collect()]
    assert query(spark, tmp_path, docs) == brute(table)


def test_several_climbs_and_other_fanout(spark, docs_of, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 9)   # two levels a climb, four climbs for 300 rows
    for fanout in (2, 3):
        docs = docs_of([f"text {i}" for i in range(300)])
        want = {t[0]: t[1:5] for t in brute([r.asDict() for r in docs.collect()], fanout)}
        got = M.manifest(docs, fanout=fanout).withColumn("proof", M.proof_digest(F.col("path")))
        assert {r.doc_id: (r.leaf, r.subroot, r.root, r.proof) for r in got.collect()} == want


def test_tampering_is_found_and_empty_table(spark, tmp_path, docs_of):
    got = query(spark, tmp_path, docs_of([f"t{i}" for i in range(50)]))
    assert {r[0] for r in got if not r[6]} == {i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 0}
    assert M.manifest(docs_of([])).count() == 0
