"""The pipeline against its stages worked out by hand on a small corpus."""

import hashlib
import random

import pytest

import corpus_pipeline
from tests.llm.test_text_operators import DOCS, plain_leaks, plain_simhash
from tidemark.llm import bpe, pii, quality


def corpus(rng):
    words = ["the", "of", "and", "river", "stone", "winter", "bread", "walks", "under", "bright", "harbour", "letter", "garden", "slowly", "seven"]
    good = lambda: ". ".join(" ".join(rng.choices(words, k=9)).capitalize() for _ in range(6)) + "."
    bad = lambda: " | ".join(rng.choices(words, k=40)) + " !!!! ####"
    item = "zeta eta theta iota kappa lamda mu nu xi omikron pi rho sigma tau upsilon phi chi psi omega"
    texts, labels = [], []
    for i in range(160):
        y = rng.random() < 0.75
        texts.append(good() if y else bad())
        labels.append((i, int(y), 0))
    texts[5], texts[9] = texts[4], texts[4].upper()  # copies: equal fingerprints
    texts[20] = texts[20] + " " + item + ". " + good()  # a leak
    texts[30] = texts[30] + " Card 4111111111111111, mail a.b@mail.example.com."
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [rows[40], (None, good(), "en", "s", 1), (None, texts[4], "en", "s", 1), (41, good(), "en", "s", 1), (200, "", "en", "s", 0), (201, None, "en", "s", 0)]
    return rows, labels, [(1, item), (2, "quite another item that nobody ever copied into any of these documents"), (3, None)]


def written(spark, path, rows, labels, items):
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_pipeline_against_its_stages_by_hand(spark, tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(bpe.vocabulary())
    rows, labels, items = corpus(random.Random(21))
    path = written(spark, tmp_path, rows, labels, items)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    model = quality.learn(docs, spark.read.parquet(f"{path}/labels.parquet"))
    kept = [r for r in rows if quality.predict(model, quality.features(r[1])[None, :])[0] >= quality.THRESHOLD]
    assert 100 < len(kept) < len(rows)
    prints = [plain_simhash(r[1]) for r in kept]
    group = list(range(len(kept)))
    for i in range(len(kept)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4 and group[i] != group[j]:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    first = {}
    for r, g in zip(kept, group):
        first[g] = min(first.get(g, r), r, key=lambda r: (r[0] is None, r[0] or 0))
    distinct = list(first.values())
    leaks = {d for d, _ in plain_leaks({r[0]: r[1] for r in distinct if r[0] is not None}, dict(items))}
    assert leaks == {20}
    clean = [r for r in distinct if r[0] is None or r[0] not in leaks]
    safe = [(r["doc_id"], r["text"] or "") for r in pii.protect(spark.createDataFrame(clean, DOCS), pii.TEST_KEY).collect()]
    assert not any("4111111111111111" in t or "mail.example" in t for _, t in safe)
    want = sorted((d or -1, hashlib.sha256(" ".join(map(str, reference.encode(t, add_special_tokens=False).ids)).encode()).hexdigest()) for d, t in safe)
    got = sorted((r["doc_id"] or -1, r["ids_sha256"]) for r in corpus_pipeline.run(spark, path).collect())
    assert got == want


def test_pipeline_of_nothing(spark, tmp_path):
    path = written(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, path).count() == 0
