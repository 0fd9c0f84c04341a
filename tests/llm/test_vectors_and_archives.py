"""Vector near-duplicates, WARC archives, components, the registry and the pipeline."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import common, neighbours, registry, warc


def brute(ids, x, threshold=0.9):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    comp = np.array(ids)
    while True:
        new = np.array([min([comp[i], *comp[near[i]]]) for i in range(len(ids))])
        if (new == comp).all():
            return {k: (int(near[i].sum()), int(comp[i])) for i, k in enumerate(ids)}
        comp = new


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    parts = [rng.normal(size=(150, 16))]
    for size in (2, 5, 40, 90):  # groups under and over the list length, and one over a block
        parts.append(rng.normal(size=(1, 16)) + 0.08 * rng.normal(size=(size, 16)))
    x = np.concatenate([*parts, parts[0][:3], 2 * parts[0][:1]]).astype(np.float32)
    ids = list(range(10, 10 + len(x)))
    rows = [(i, v.tolist(), 0) for i, v in zip(ids, x)]
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] + [1.0] * 15, 0), (903, [None] + [1.0] * 15, 0), (904, [1.0, 2.0], 0), (905, [1.0, 2.0], 0), (906, [], 0), (None, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows + rows[:2] + odd, "vec_id long, embedding array<float>, label int").withColumn("u", F.lit("clash")).withColumn("m", F.lit(1))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neighbours.near_duplicates(df).collect()}
    want = brute(ids, x.astype(np.float64))
    assert {k: got[k][:2] for k in ids} == want
    assert all(got[k] == (0, k, True) for k in (900, 901, 902, 903, 906)) and got[904] == (1, 904, True) and got[905] == (1, 904, False)
    assert neighbours.near_duplicates(df.limit(0)).count() == 0


def test_neighbours_of_huge_and_tiny_vectors(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1e200]), (3, [1e-200, 0.0]), (4, [2e-200, 0.0]), (5, [5e-324, 0.0]), (6, [1.7e308, -1.7e308]), (7, [1.0, -1.0]), (8, [float("inf"), 1.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["audited_recall"]) for r in neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1, 1.0), 2: (1, 1, 1.0), 3: (2, 3, 1.0), 4: (2, 3, 1.0), 5: (2, 3, 1.0), 6: (1, 6, 1.0), 7: (1, 6, 1.0), 8: (0, 8, 1.0)}


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    edges = [*chain, *star, (3, 3), (None, 5), (160, 100), (101, 100)]
    random.Random(1).shuffle(edges)
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 7: 7, **{i: 7 for i in range(200, 260)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


PAGES = "page_id long, url string, html string"


def test_warc_round_trip_and_order(spark, tmp_path):
    body = "<p>é" + "x" * 200
    rows = [(5, "http://b.example.com/1", body), (3, "http://www.a.example.com/z?q=1#f", body), (9, "https://a.example.com/a", body), (1, None, None), (2, "http://a.example.com/\r\nX: y", "short"), (4, "u", "short"), (6, "bad://[", "WARC/1.1\r\n\r\n" + body), (None, "n", "q" * 150)]
    pages = spark.createDataFrame(rows, PAGES).withColumn("first", F.lit("clash")).withColumn("run", F.lit(1))
    path = str(tmp_path / "w")
    warc.write(pages, path)
    out = warc.index(spark, path).collect()
    assert [warc.order(tuple(r)) for r in out] == sorted(warc.order(tuple(r)) for r in out)
    by = {r["page_id"]: r for r in out}
    assert {k: (v["record_type"], v["refers_to"]) for k, v in by.items()} == {5: ("revisit", 3), 3: ("response", None), 9: ("revisit", 3), 1: ("response", None), 2: ("response", None), 4: ("response", None), 6: ("response", None), None: ("response", None)}
    assert by[5]["payload_bytes"] == len(body.encode()) and by[1]["payload_bytes"] == 0 and by[5]["payload_digest"] == by[3]["payload_digest"]
    assert by[3]["url_key"] == "com,example,a)/z?q=1"
    empty = str(tmp_path / "e")
    warc.write(pages.limit(0), empty)
    assert warc.index(spark, empty).count() == 0


def test_warc_large_pages_lie_in_files_of_their_own(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 1_500_000)
    big = [(i, f"u{i}", chr(97 + i % 3) * (600_000 + i % 3)) for i in range(6)]
    pages = spark.createDataFrame([*big, (9, "s", "y" * 120), (9, "s", "y" * 120), (9, "t", "z" * 130), (10, "t", "z" * 130)], PAGES).coalesce(1)
    path = str(tmp_path / "w")
    warc.write(pages, path)
    sizes = [sum(1 for _ in warc.records(warc.inflate(f.read_bytes()))) for f in (tmp_path / "w").glob("*.gz")]
    assert sum(sizes) == 10 and sorted(sizes) == [2, 2, 2, 4]
    out = sorted((r["page_id"], r["record_type"], -1 if r["refers_to"] is None else r["refers_to"]) for r in warc.index(spark, path).collect())
    assert out == [(0, "response", -1), (1, "response", -1), (2, "response", -1), (3, "revisit", 0), (4, "revisit", 1), (5, "revisit", 2), (9, "response", -1), (9, "response", -1), (9, "response", -1), (10, "revisit", 9)]
    whole = next((tmp_path / "w").glob("*.gz")).read_bytes()
    with pytest.raises(ValueError, match="ends within"):
        list(warc.records(warc.inflate(whole)[:-20]))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 64])
def test_loser_tree_sorts(k):
    rng = random.Random(k)
    lists = [sorted(rng.choices(range(50), k=rng.randint(0, 30))) for _ in range(k)]
    assert list(warc.LoserTree(lists, key=lambda x: (x,))) == sorted(x for xs in lists for x in xs)


def test_loser_tree_holds_one_item_a_stream():
    taken = []

    def stream(n):
        for x in range(n, 300, 3):
            taken.append(x)
            yield x

    tree = iter(warc.LoserTree([stream(i) for i in range(3)], key=lambda x: x))
    assert [next(tree) for _ in range(30)] == list(range(30)) and len(taken) <= 33


def test_captures_of_one_url_are_ordered_by_time_over_many_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "HEAD_ROWS", 1)
    monkeypatch.setattr(warc, "FILE_RECORDS", 50)
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    urls = ["http://hot.example.com/"] * 6 + ["http://b.example.com/x", "https://www.a.example.com/é"]
    rows = [(i, rng.choice(urls), f"{rng.randrange(40)}" + "y" * 150, start + dt.timedelta(hours=rng.randrange(200))) for i in range(900)]
    rows += [(7, urls[0], "again", start)] * 40  # one record many times
    pages = spark.createDataFrame(rows, PAGES + ", at timestamp").repartition(6)
    path = str(tmp_path / "w")
    warc.write(pages, path, time_col="at")
    ordered = warc.index(spark, path, range_rows=20)
    assert ordered.rdd.getNumPartitions() > 40
    sizes = [r["count"] for r in ordered.groupBy("part").count().collect()]
    assert max(sizes) <= 120 and sum(sizes) == 940  # near 20 captures a range, the hot URL and the repeated record cut as well
    got = sorted(warc.positioned(ordered).collect(), key=lambda r: r["position"])
    assert [r["position"] for r in got] == list(range(1, 941))
    want = sorted((warc.url_key(u), f"{t:%Y-%m-%dT%H:%M:%SZ}", i) for i, u, _, t in rows)
    assert [(r["url_key"], r["captured"], r["page_id"]) for r in got] == want
    seen = {}
    for r in got:
        seen[r["url_key"]] = seen.get(r["url_key"], 0) + 1
        assert r["nth_of_url"] == seen[r["url_key"]]


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_pipeline_keeps_columns_and_takes_effect(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents").withColumn("id", F.lit("clash"))
    start = docs.count()
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        names = docs.columns
        docs = common.stored(stage(spark, docs, "/root/testdata/sf0.001"))
        assert docs.columns == names
        sizes.append(docs.count())
    assert start > sizes[0] >= sizes[1] >= sizes[2] == sizes[3] > start // 2
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == sizes[3]
