import random

from panelmart.llm import urls as U


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for kind, h, p in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, kind)
    return host, path, *(best or (None, None))


ODD = [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.ORG/es/x", "http://example.org/en/10", "http://notexample.org/es/1",
       "http://a.com/de/", "http://a.com/de", "http://a.com?x=1#y", "http://a.com#/fr/", "x://é.org/Ä", "http://org/", "http://a.b://c.com/fr/1",
       "http://h.com/" + "p/" * 20_000, "http://ÀB.com/fr/", "http://a.org/a\nb?c"]


def test_rules_match_brute_force(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url").collect()
    rows = [(r.page_id, r.url) for r in pages] + [(10_000 + i, u) for i, u in enumerate(ODD)] + [(None, "http://a.com/de/1")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, host string, label int")
    got = U.filter_urls(frame).collect()
    assert len(got) == len(rows)
    want = {i: brute(u) for i, u in rows}
    for r in got:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict or verdict is None and r.verdict in ("allow", "block")
        if not host and not path:
            assert r.verdict == "allow" and r.score == 0


def test_held_out_accuracy(spark):
    """Trees fitted on half of the labelled hosts tell the other half."""
    labels = U.seed_labels(spark.read.parquet("/root/testdata/sf0.1/pages.parquet")).collect()
    rng = random.Random(0)
    hosts = sorted({brute(r.url)[0] for r in labels})
    train = set(rng.sample(hosts, len(hosts) // 2))
    frame = spark.createDataFrame([(r.url, r.label) for r in labels if brute(r.url)[0] in train], "url string, label int")
    test = [(i, r.url, r.label) for i, r in enumerate(labels) if brute(r.url)[0] not in train]
    pages = spark.createDataFrame([(i, u) for i, u, _ in test], "page_id long, url string")
    got = {r.page_id: r.verdict == "block" for r in U.filter_urls(pages, labelled=frame, rules=[]).collect()}
    right = [got[i] == bool(y) for i, _, y in test]
    assert sum(right) >= 0.97 * len(right)
    bad = [got[i] for i, _, y in test if y]
    assert sum(bad) >= 0.8 * len(bad)


def test_one_class_or_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in U.filter_urls(pages).collect()} == {"allow"}
    assert U.filter_urls(pages.limit(0)).count() == 0


def test_features(spark):
    from pyspark.sql import functions as F

    url = "http://a-b.example.com/x/y1?p=1&q=22#z"
    c = F.col("url")
    row = spark.createDataFrame([(url,)], "url string").select(
        *[v.alias(k) for k, v in U.lexical(c, U.url_host(c), U.url_path(c)).items()]).first()
    assert (row.url_length, row.host_length, row.depth, row.hyphens, row.params, row.query_length) == (38, 15, 2, 1, 2, 8)
    assert abs(row.digit_ratio - 4 / 38) < 1e-12 and 3.0 < row.entropy < 3.6


def _spread_urls(rng, good_suffixes, bad_suffixes, n_good, n_bad):
    good = [f"http://www.{rng.choice(['news', 'library', 'garden', 'museum'])}.{rng.choice(good_suffixes)}/{rng.choice('abcd')}/page" for _ in range(n_good)]
    bad = [f"http://{rng.randrange(10**6)}-{rng.choice(U.SEED_TERMS)}-{rng.randrange(10**6)}.{rng.choice(bad_suffixes)}/?id={rng.randrange(10**6)}&r=1"
           for _ in range(n_bad)]
    return good, bad


def test_many_suffixes(spark):
    """Unwanted URLs in rare suffixes, among 70 larger ones, and in suffixes never labelled."""
    rng = random.Random(7)
    common, rare, unseen = [f"g{i}" for i in range(70)], [f"b{i}" for i in range(200)], [f"u{i}" for i in range(50)]
    good, bad = _spread_urls(rng, common, rare, 7000, 400)
    labelled = spark.createDataFrame([(u, 0) for u in good] + [(u, 1) for u in bad], "url string, label int").distinct()
    held_good, held_bad = _spread_urls(rng, common, unseen, 500, 200)
    for table, options in (([*good, *bad], {}), ([*held_good, *held_bad], {"labelled": labelled})):
        pages = spark.createDataFrame([(i, u) for i, u in enumerate(table)], "page_id long, url string")
        got = {r.page_id: r.verdict for r in U.filter_urls(pages, rules=[], **options).collect()}
        n_good = len(good) if not options else len(held_good)
        assert all(got[i] == "allow" for i in range(n_good))
        assert sum(got[i] == "block" for i in range(n_good, len(table))) >= 0.95 * (len(table) - n_good)


def test_sample_keeps_the_rare_class(spark):
    """The bound on rows holds for each class: a rare one is not sampled away."""
    rng = random.Random(8)
    good, bad = _spread_urls(rng, ["com", "net"], ["com", "net"], 4000, 60)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*good, *bad])], "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.filter_urls(pages, rules=[], sample_rows=100).collect()}
    assert sum(got[len(good) + i] == "block" for i in range(len(bad))) >= 0.95 * len(bad)
    assert sum(got[i] == "allow" for i in range(len(good))) >= 0.99 * len(good)
