"""Line de-duplication, whitening and token alignment against brute force; what extraction keeps of an article."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import alignment, html, lines, whitening


# lines

BLANKS = " \t\n\x0b\f\r"


def expected_lines(rows, least=40, docs=5):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                holders[key(line)].add(-1 if i is None else i)
    out = Counter()
    for i, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for x in all_lines if len(holders[key(x)]) < docs or max(holders[key(x)]) == i]
        out[(i, "\n".join(kept), len(all_lines), len(all_lines) - len(kept))] += 1
    return out


def odd_documents():
    long, other = "The Same Long Line, Repeated In Very Many Documents.", "é" * 39 + "x and then some more of it"
    rows = [(i, f"{long}\n\nown {i}\n  {long.upper()} \t") for i in range(30)]
    rows += [(100 + i, f"{other}\r\n{'y' * 40}\n{other}") for i in range(5)] + [(200 + i, "z" * 41) for i in range(4)]
    rows += [(300, None), (301, ""), (302, "\n"), (303, "\n\n" + long), (None, long + "\nnameless"), (None, other), (None, None)]
    rows += [(5, long + "\nanother text of an id that repeats"), (7, f"{long}\n\nown 7\n  {long.upper()} \t"), (400, "\n".join([long] * 3000))]
    return rows


@pytest.mark.parametrize("deliveries,fanout", [(1, 2), (4, 2), (3, 4)])
def test_lines_against_brute_force(spark, deliveries, fanout):
    rows = odd_documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("h", F.lit(1)).withColumn("line", F.lit("clash"))
    got = Counter(map(tuple, lines.dedup(df, deliveries=deliveries, fanout=fanout).select("doc_id", "text", "n_lines", "n_dropped").collect()))
    assert got == expected_lines(rows)


def test_lines_of_nothing(spark):
    assert lines.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    short = spark.createDataFrame([(1, "a\nb"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, lines.dedup(short).collect())) == [(1, "a\nb", 2, 0), (2, "", 1, 0)]


def test_runs_are_levelled_and_joined_in_place(spark):
    runs = lines.Runs(spark, fanout=2, buckets=4)
    for i in range(7):  # keys 3 i to 3 i + 5, held by document i
        runs.add(spark.createDataFrame([(i, k, -k) for k in range(3 * i, 3 * i + 6)], "doc_id long, h long, g long"))
        assert all(len(level) < 2 for level in runs.levels)
    assert [len(level) for level in runs.levels] == [1, 1, 1]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = runs.new_keys(runs.tables()[0])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    got = {r["h"]: (r["n"], r["last"]) for r in runs.totals().collect()}
    assert got == {k: (1 + (3 <= k < 21), max(0, k // 3 - 1)) for k in range(24)}


# whitening


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n", F.lit("clash"))


def test_whitening_against_a_dense_solver(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 12)) * np.linspace(3, 0.2, 12) + 7
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, []), (904, [1.0]), (905, [1e300] * 12), (906, [float("inf")] * 12), (None, x[0].tolist())]
    got = whitening.whiten(vectors(spark, rows + odd).repartition(5)).toPandas()
    x = np.vstack([x, x[:1]])
    y = np.floor(1024 * x).astype(np.int64) + 100_000
    n, total = len(y), y.sum(axis=0)
    c = (n * y - total) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(got) == 8 * n and set(got["n"]) == {n} and got["vec_id"].isna().sum() == 8
    got = got[got["vec_id"].notna()]
    w = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = (c @ u[:, :8] / np.sqrt(e[:8]))[:400]
    assert np.allclose(np.abs((w * want).sum(axis=0)), (want * want).sum(axis=0), rtol=1e-9)
    assert np.allclose(w, want * np.sign((w * want).sum(axis=0)), atol=1e-9)
    assert np.allclose(got.groupby("component")["explained"].first(), e[:8] / e.sum(), rtol=1e-9)
    assert got["deviation"].iloc[0] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(y[int(got["vec_id"].iloc[0])], total))
    assert got["identity_error"].iloc[0] < 1e-9


def test_whitening_of_few_equal_and_no_vectors(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # nothing varies
    got = whitening.whiten(vectors(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0])])).collect()
    assert [(r["vec_id"], r["component"]) for r in sorted(got, key=lambda r: r["vec_id"])] == [(1, 1), (2, 1), (3, 1)]
    wide = whitening.whiten(vectors(spark, [(1, [2.0**40, 0.0]), (2, [0.0, 1.0]), (3, [5.0, -(2.0**40)])]), components=2).collect()
    assert {r["deviation"] for r in wide} == {None} and wide[0]["identity_error"] < 1e-6


def test_feast_finds_what_a_dense_solver_finds():
    rng = np.random.default_rng(2)
    for values in (rng.random(40), np.r_[np.ones(20), np.zeros(20)], np.r_[1, 1 - 1e-9, np.full(38, 0.5)], np.geomspace(1, 1e-12, 40)):
        q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
        v = (q * values) @ q.T
        v = (v + v.T) / 2
        e, u = whitening.leading(v, 8)
        want = np.sort(np.linalg.eigvalsh(v))[::-1][:8]
        assert np.allclose(e, want[: len(e)], atol=1e-13) and np.allclose(v @ u, u * e, atol=1e-12) and np.allclose(u.T @ u, np.eye(len(e)), atol=1e-10)
        for s in (0.1, 0.5001, 0.9):
            assert whitening.inertia(v - s * np.eye(40)) == (np.linalg.eigvalsh(v) > s).sum()


def test_exact_gram():
    rng = np.random.default_rng(4)
    x = rng.integers(-(1 << 50), 1 << 50, size=(20, 3))
    assert whitening.exact_gram(x) == (x.astype(object).T @ x.astype(object)).tolist()


# alignment


def expected_alignments(texts):
    a = alignment.aligner(None, None)
    docs, count = [], Counter()
    for t in texts:
        raw = (" " + t).encode()
        ids = (a.a.encode(" " + t, add_special_tokens=False).ids, a.b.encode(t)) if t else ([], [])
        if not t or any(b"".join(names[i] for i in x) != raw for x, names in zip(ids, (a.bytes_a, a.bytes_b))):
            docs.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(names[i]) for i in x]).tolist(), range(len(x)))) for x, names in zip(ids, (a.bytes_a, a.bytes_b))]
        both = sorted(set(ends[0]) & set(ends[1]))
        links = [(ids[0][ends[0][e]], ids[1][ends[1][e]]) for e in both]
        count.update(links)
        groups, at = [], (0, 0)
        for e in both:
            to = ends[0][e] + 1, ends[1][e] + 1
            groups.append("|".join(",".join(map(str, x[i:j])) for x, i, j in zip(ids, at, to)))
            at = to
        docs.append((len(ids[0]), len(ids[1]), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else (*d[:3], len(d[3]), sum(count[x] == best[x[1]] for x in d[3]), sum(count[x] for x in d[3]), d[4]) for d in docs]


def test_alignment_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_ROWS", 50)
    rng = random.Random(1)
    marks = "ab \u00e9\u6f22\n\t  \u2581\x1c\u3000x1'!\u200b\U0001f642\x00\x85\xa0\r"
    texts = [None, "", " ", "  ", "a", "\n", "\n\na", "<|endoftext|> <s></s>", "a\u2581b", "x" * 5000, "don't  stop\n  now ", "if (x) {\r\n  y();\r\n}"]
    texts += ["".join(rng.choice(marks) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("block", F.lit("clash")).repartition(3)
    got = {r["doc_id"]: tuple(r)[1:8] for r in alignment.alignments(df).collect()}
    assert got == dict(enumerate(expected_alignments([t or "" for t in texts])))


def test_alignment_of_nothing_and_of_rows_without_ids(spark):
    schema = "doc_id long, text string"
    assert alignment.alignments(spark.createDataFrame([], schema)).count() == 0
    got = sorted(map(tuple, alignment.alignments(spark.createDataFrame([(None, "word"), (1, None), (1, "word")], schema)).collect()), key=repr)
    assert [r[1:5] for r in got] == [(0, 0, 0, 0), (1, 1, 1, 1), (1, 1, 1, 1)] and [r[5] for r in got] == [0, 1, 1]


def test_coalesce_groups_and_overlaps():
    starts, ends, side = np.array([0, 2, 5, 0, 3, 5]), np.array([2, 5, 6, 3, 5, 6]), np.array([0, 0, 0, 1, 1, 1])
    order, group, a, b = alignment.coalesce(starts, ends, side)
    of = dict(zip(order.tolist(), group.tolist()))
    assert [of[i] for i in range(6)] == [0, 0, 1, 0, 0, 1]
    assert sorted(zip(a.tolist(), b.tolist())) == [(0, 3), (1, 3), (1, 4), (2, 5)]


# what op3 keeps of an article

BODY = "<h1>Title here</h1><p>One two three four five six seven.</p><p>More words in a second paragraph of text.</p>"
TEXT = "Title here\nOne two three four five six seven.\nMore words in a second paragraph of text."


@pytest.mark.parametrize("wrap", ['<section data-title="the hidden cost of x">{}</section>', '<div style="overflow: hidden !important">{}</div>', '<div class="content hidden md:block">{}</div>', "<div title='display: none'>{}</div>"])
def test_values_that_only_name_hiding_hide_nothing(wrap):
    assert html.extract("<nav><a>Home</a></nav>" + wrap.format(BODY)) == TEXT


@pytest.mark.parametrize("hidden", ["hidden", 'hidden=""', 'aria-hidden="true"', "ARIA-HIDDEN='true'", 'style="display:none"', "style='color: red; visibility : hidden'"])
def test_hidden_elements_are_left_out(hidden):
    assert html.extract(f"<article>{BODY}<div {hidden}>gone</div></article>") == TEXT


def test_blocks_of_an_article_stay_whole():
    parts = '<p title="a hidden gem">gem</p><p class="form-text">form words</p><p class="editor-notice">note words</p>'
    assert html.extract(f"<article>{BODY}{parts}<p class='advert'>Buy!</p></article><footer>x</footer>") == TEXT + "\ngem\nform words\nnote words"
    assert html.extract(f"<article><h1>Title</h1><table><tr><td>1<td>2</table>{BODY}<p>End.</article><p>Far</p>") == "Title\n1\n2\n" + TEXT + "\nEnd."
    assert html.extract(f"<article>{BODY}</article><article><p>Other</p></article>").startswith(TEXT)
