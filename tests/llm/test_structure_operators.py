"""Nearest neighbours, URL rules, near-duplicates, exact repeats and the quality classifier on small tables."""

from __future__ import annotations

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import exact_substrings, posting_lists, quality, simhash_dedup, url_filter
from millrace.llm.components import components
from millrace.llm.suffix_array import suffix_array

SF = "/root/testdata/sf0.001"


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(700, 12))
    vectors[300:500] = vectors[0]  # one very common vector
    rows = [(i, [float(x) for x in v], "extra") for i, v in enumerate(vectors)]
    rows += [(900, None, ""), (901, [0.0] * 12, ""), (902, [float("nan")] * 12, ""), (903, [float("inf")] + [1.0] * 11, ""), (904, [None] * 12, ""), (None, [1.0] * 12, ""), (905, [1.0] * 5, "")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    index = posting_lists.build(table, 20)
    asked = table.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    got: dict[int, list] = {}
    for r in posting_lists.search(index, asked).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 700, 20))
    hit = 0
    for q, found in got.items():
        scores = np.round(vectors @ vectors[q], 9)
        want = [i for i in np.lexsort((np.arange(700), -scores)) if i != q][:20]
        hit += len({f[1] for f in found} & set(want))
        assert [f[0] for f in found] == list(range(1, 21))
        assert all(abs(s - vectors[v] @ vectors[q]) < 1e-9 for _, v, s in found)
    assert hit >= 0.9 * 20 * len(got)
    assert [f[1] for f in got[0]] == list(range(300, 320))


def test_neighbours_of_few_or_no_vectors(spark):
    table = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 1.0])], "vec_id long, embedding array<float>")
    asked = table.limit(1).withColumnRenamed("vec_id", "query_id")
    assert [(r.rank, r.vec_id) for r in posting_lists.search(posting_lists.build(table, 20), asked).collect()] == [(1, 1), (2, 2)]
    assert posting_lists.search(posting_lists.build(table.limit(0), 20), asked).count() == 0


def test_neighbours_of_an_id_with_two_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.5]), (1, [0.0, 1.0]), (2, [0.9, 0.0]), (3, [0.1, 0.0]), (4, [0.0, 1.0]), (1, [1.0, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = table.filter("vec_id IN (0, 4)").withColumnRenamed("vec_id", "query_id")
    found = posting_lists.search(posting_lists.build(table, 3), asked).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in found] == [(0, 1), (0, 2), (0, 3), (4, 1), (4, 0), (4, 2)]
    assert found[0].score == 1 and found[3].score == 1


def test_many_lists_are_pruned(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "BLOCK", 256)
    monkeypatch.setattr(posting_lists, "QUERIES", 32)
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(60, 24))[rng.integers(0, 60, 3000)] + 0.5 * rng.normal(size=(3000, 24))
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    index = posting_lists.build(table, 20)
    assert len(index.centroids.points) >= 128 and index.bundle < len(index.centroids.points) / 4
    asked = table.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    got: dict[int, set] = {}
    for r in posting_lists.search(index, asked).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = sum(len(got[q] & set(_best(vectors, q))) for q in got)
    assert len(got) == 150 and hit >= 0.9 * 20 * 150
    size = {r.list: r["count"] for r in index.postings.groupBy("list").count().collect()}
    read = sum(size.get(x, 0) for lists in index.centroids.read(vectors[::20]) for x in lists.tolist())
    assert read < 150 * 3000 / 3


def test_other_bundles_return_only_what_may_be_among_the_best(spark, monkeypatch):
    monkeypatch.setattr(posting_lists, "BLOCK", 64)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(2000, 16))
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    index = posting_lists.build(table, 20)
    returned = []
    compared = posting_lists._compared

    def counted(reading, postings, k):
        out = compared(reading, postings, k)
        returned.append((out.count(), reading.count()))
        return out

    monkeypatch.setattr(posting_lists, "_compared", counted)
    asked = table.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    rows = posting_lists.search(index, asked).collect()
    bundles = sum(n for _, n in returned)
    assert bundles > 8 * 100 and sum(n for n, _ in returned) < 0.6 * 21 * bundles
    lists = index.centroids.read(vectors[::20])
    of = {r.entry: [] for r in index.entries.collect()}
    for r in index.postings.collect():
        of[r.entry].append(r.list)
    for q in range(0, 2000, 20):  # as from all lists that it reads, at once
        own = set(lists[q // 20].tolist())
        there = [i for i in range(2000) if i != q and own & set(of[i])]
        want = sorted(there, key=lambda i: (-float((vectors[i] * vectors[q]).sum()), i))[:20]
        assert [r.vec_id for r in sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)] == want


def _best(vectors, q):
    scores = -vectors @ vectors[q]
    return [int(i) for i in np.argsort(scores, kind="stable") if i != q][:20]


def test_url_rules(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "", "block"), ("a.com", "", "allow"), ("a.com", "/x", "block"), ("a.com", "/x", "allow"), (None, "/n", "allow")]
    urls = [None, "", "no scheme", "http://Example.ORG/es/1?q", "https://www.example.org/es", "http://example.org", "http://badexample.org/es/x", "http://b.a.com/xy#z", "http://a.com?x://y", "http://com.a/", "http://é.com/\n", "http:///n/1"]
    table = spark.createDataFrame([(i, u, "own") for i, u in enumerate([*urls, *urls])], "page_id long, url string, rule string")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: r for r in url_filter.judge(table, frame).collect()}
    given: dict[tuple[str, str], str] = {}
    for h, p, v in rules:
        given[h or "", p] = max(v, given.get((h or "", p), ""))
    for i, url in enumerate([*urls, *urls]):
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fit = [(len(h + p), h + p, v) for (h, p), v in given.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, "allow"))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, best[1], best[2]), url
    assert url_filter.judge(table, frame.limit(0)).filter("rule IS NULL AND verdict = 'allow'").count() == len(got)
    assert url_filter.judge(table.limit(0), frame).count() == 0


def test_bit_slices_find_every_near_pair():
    rng = random.Random(8)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = [b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 8))) for b in base for _ in range(40)]
    rng.shuffle(prints)
    array = np.array(prints, np.uint64)
    planes = simhash_dedup.bit_planes(array)
    for by in (1, 5, 63, 64, 65, 130):
        rows = np.arange(len(prints) - by)
        want = [i for i in rows if (prints[i] ^ prints[i + by]).bit_count() <= 4]
        assert simhash_dedup.near_rows(planes, rows, by, 4).tolist() == want


@pytest.mark.parametrize("tile", [4, 512])
def test_near_duplicate_components(spark, tile):
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(5)]
    prints = sorted({b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 5))) for b in base for _ in range(30)})
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 4:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    printed = spark.createDataFrame(signed + [(i + 1000, p) for i, p in signed], "doc_id long, fp long")
    got = {r.fp % (1 << 64): r.component_id for r in simhash_dedup.label_components(printed, "doc_id", tile=tile).collect()}
    ids = {p: i for i, p in enumerate(prints)}
    assert got == {p: min(ids[q] for q in prints if root(q) == root(p)) for p in prints}


def test_near_duplicates_edges(spark):
    rows = [(5, None), (3, ""), (4, " \t"), (7, "One two"), (2, "one TWO"), (None, "one two"), (9, "word " * 50_000), (None, "alone here")]
    got = simhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in got if r.doc_id is not None}
    assert found[5] == found[3] == found[4] == ("0" * 16, 3)
    assert found[7] == found[2] and found[7][1] == 2
    assert sorted((r.component_id for r in got if r.doc_id is None), key=str) == [2, None]
    assert simhash_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_chain_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(5, 5), (1, 0), (100, 101), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_suffix_arrays():
    rng = random.Random(1)
    for _ in range(3000):
        text = [rng.randrange(rng.choice((1, 2, 3, 6))) for _ in range(rng.randrange(30))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def naive_repeats(rows):
    seen, out = [], {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        body = (text or "").encode()
        gone = bytearray(len(body))
        own = {body[k : k + 50] for k in range(len(body) - 49)}
        before = set().union(*[w for d, w in seen if d is not None and (doc is None or d < doc)])
        for k in range(len(body) - 49):
            if body[k : k + 50] in before:
                gone[k : k + 50] = b"\1" * 50
        seen.append((doc, own))
        kept = bytes(c for c, g in zip(body, gone) if not g)
        runs = sum(1 for k in range(len(body)) if gone[k] and not (k and gone[k - 1]))
        out[doc] = (len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_exact_repeats(spark):
    rng = random.Random(7)
    pool = ["".join(rng.choice("abé ") for _ in range(rng.randrange(20, 90))) for _ in range(12)]
    rows = [(i, "".join(rng.choices(pool, k=rng.randrange(6)))) for i in range(60)]
    rows += [(70, "a" * 400), (71, "b" + "a" * 60), (72, "x" * 49), (73, "x" * 49), (74, None), (None, rows[3][1] + "tail"), (75, "ab" * 20_000), (76, "ba" * 30)]
    frame = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, spans int").repartition(5)
    got = exact_substrings.remove_repeats(frame)
    assert got.columns == ["doc_id", "text", "spans", "stripped"]
    want = naive_repeats(rows)
    for r in got.collect():
        s = r.stripped
        assert (s.n_bytes, s.n_removed, s.n_spans, hashlib.sha256(s.kept).hexdigest()) == want[r.doc_id], r.doc_id
    again = exact_substrings.remove_repeats(frame.unionByName(frame)).select("doc_id", "stripped.n_removed").distinct()
    assert again.count() == len(rows)
    assert exact_substrings.remove_repeats(frame.limit(0)).count() == 0


def test_quality_learns_from_both_views(spark):
    rng = random.Random(3)

    def good():
        return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 8))) for _ in range(rng.randrange(20, 60))) + "."

    rows = [(i, good() if i % 3 else " | ".join(good().split()), "en", f"s{i % 4}") for i in range(300)]
    rows += [(400, None, None, None), (401, "", "en", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 300, 2)] + [(7, None), (999, 1), (4, 1)], "doc_id long, quality int")
    scored = docs.select("doc_id", quality.score(spark, quality.fit(docs, labels)).alias("p"))
    got = {r.doc_id: r.p for r in scored.collect()}
    right = sum((got[i].score >= quality.THRESHOLD) == (i % 3 > 0) for i in range(1, 300, 2))
    assert right >= 0.95 * 150 and all(0 <= p.score <= 1 for p in got.values())
    kept = docs.select(quality.score(spark, quality.fit(docs, labels.limit(0))).alias("p"))
    assert kept.filter("p.score < 1").count() == 0
    assert docs.limit(0).select(quality.score(spark, quality.fit(docs.limit(0), labels)).alias("p")).count() == 0


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    from pyspark.sql import functions as F

    extra = docs.limit(1).withColumns({"doc_id": F.lit(None).cast("long"), "source": F.lit(None).cast("string")})
    start = docs.unionByName(extra).unionByName(docs.limit(3)).withColumns({"fp": F.lit(1), "spans": F.lit("s"), "matches": F.lit(2)})
    now = start
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.land(stage(spark, now, SF))
        assert now.columns == start.columns, name
    ids = [r.doc_id for r in now.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and 0.5 * docs.count() < len(ids) < docs.count()
    assert now.filter("text rlike '[0-9a-f]{16}'").count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, now, SF).filter("NOT decodes_back").count() == 0
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, start.limit(0), SF).count() == 0, name
