"""Benchmark decontamination over item-sized windows, in SQL functions only.

A document leaks an item if some window of the item's number of words holds at least 0.8 of the item's five-word
shingles, each weighted by its rarity among the items. Such a window shares a shingle with its item, so every shingle of
every document is looked up among the items' shingles; a hit at word p of the document and word q of the item fixes the
window that starts at p - q. Every such window is verified on the exact weighted shingles. Its words are fingerprinted by
SimHash too, for its distance from the item; no window is dropped by it: windows at 0.8 can differ in any number of bits,
and multi-index blocks over so many bits would send every window to every item.

Items go out in passes of at most PASS_SHINGLES shingles, so what is broadcast has a fixed bound whatever the benchmark's
size. Items shorter than five words are matched as one shingle of their length; items without words match nothing; of items
that share an id one counts. Documents without an id, null and empty texts match nothing; rows that share an id are one
document that leaks what any of them leaks; a tie between windows goes to the earliest.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, stored

SHINGLE, SIMILARITY = 5, 0.8
PASS_SHINGLES = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; an empty array for null."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(words: Column, k: int) -> Column:
    """Hashes of every run of k words, in order; empty below k words."""
    at = lambda i, j: F.get(words, i + j)
    return F.when(F.size(words) >= k, F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: F.xxhash64(*[at(i, j) for j in range(k)]))).otherwise(F.array().cast("array<long>"))


def simhash(words: Column) -> Column:
    """64 bits, each set if it is set in over half of the words' hashes."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def bit(h, b):
        ones = F.size(F.filter(h, lambda x: F.call_function("bit_get", x, b) == 1))
        return F.when(2 * ones > F.size(h), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    return F.element_at(F.transform(F.array(hashes), lambda h: F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda s, b: s.bitwiseOR(bit(h, b)))), 1)


def prepared_items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per item with words: item_id, size, k, words, hashes, fp."""
    base = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item_id"), words_of(F.col(text_col)).alias("words")).where(F.size("words") > 0).dropDuplicates(["item_id"])
    k = F.least(F.size("words"), F.lit(SHINGLE))
    hashed = F.coalesce(*[F.when(k == n, shingles(F.col("words"), n)) for n in range(1, SHINGLE + 1)])
    return base.select("item_id", F.size("words").alias("size"), k.alias("k"), hashed.alias("hashes"), simhash(F.col("words")).alias("fp"))


def leaks(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """Rows (doc_id, item_id, start, words, distance, similarity): for each document and item that it leaks, the best
    window, the earliest of equals."""
    known = cut(prepared_items(items, item_col, item_text))
    n, total = known.agg(F.count("*"), F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()
    lengths = sorted(r[0] for r in known.select("k").distinct().collect())  # at most five values
    if not lengths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, start int, words int, distance int, similarity double")
    passes = max(1, math.ceil(total / PASS_SHINGLES))
    grams = known.select("item_id", "size", "k", "fp", F.posexplode("hashes").alias("q", "h"))
    rarity = grams.groupBy("h").agg(F.log1p(F.lit(float(n)) / F.count_distinct("item_id")).alias("weight"))
    read = docs.where(F.col(doc_col).isNotNull()).select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    words = read.select("doc_id", words_of(F.col("text")).alias("w"))
    if len(lengths) == 1:
        seen = words.select("doc_id", F.lit(lengths[0]).alias("k"), F.posexplode(shingles(F.col("w"), lengths[0])).alias("p", "h"))
    else:  # all lengths in one reading
        placed = lambda k: F.transform(shingles(F.col("w"), k), lambda h, p: F.struct(F.lit(k).alias("k"), p.alias("p"), h.alias("h")))
        each = [placed(k) for k in lengths]
        seen = words.select("doc_id", F.inline(F.concat(*each)))
    found = None
    for p in range(passes):
        mine = grams.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p) if passes > 1 else grams
        hits = seen.join(F.broadcast(mine.select("h", F.col("k").alias("item_k"), "q", "size", "item_id", "fp")), "h").where("k = item_k")
        part = hits.select("doc_id", "item_id", "k", F.greatest(F.col("p") - F.col("q"), F.lit(0)).alias("start"), "size", "fp").distinct()
        found = part if found is None else found.unionByName(part)
    # the hits alone are carried on; the texts that they lie in are read again for the windows
    found = stored(found)
    hit = read.join(found.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", words_of(F.col("text")).alias("w"))
    cutout = hit.join(found, "doc_id").select("doc_id", "item_id", "k", "start", "fp", F.slice("w", F.col("start") + 1, F.col("size")).alias("window"))
    distance = F.bit_count(simhash(F.col("window")).bitwiseXOR(F.col("fp")))
    windows = cut(cutout.distinct().withColumns({"distance": distance, "own": F.xxhash64("window")}))
    # exact verification: for each shingle of the item the smaller of both counts, weighted
    wanted = grams.groupBy("item_id", "h").agg(F.count("*").alias("n")).join(rarity, "h")
    whole = wanted.groupBy("item_id").agg(F.sum(F.col("n") * F.col("weight")).alias("whole"))
    hashed = F.coalesce(*[F.when(F.col("k") == n, shingles(F.col("window"), n)) for n in range(1, SHINGLE + 1)])
    held = windows.select("doc_id", "item_id", "start", "own", "distance", F.size("window").alias("words"), F.explode(hashed).alias("h"))
    counted = held.groupBy("doc_id", "item_id", "start", "own", "distance", "words", "h").agg(F.count("*").alias("m"))
    scored = (
        counted.join(wanted, ["item_id", "h"])
        .groupBy("doc_id", "item_id", "start", "own", "distance", "words")
        .agg(F.sum(F.least("n", "m") * F.col("weight")).alias("shared"))
        .join(whole, "item_id")
        .withColumn("similarity", F.round(F.col("shared") / F.col("whole"), 6))
        .where(F.col("similarity") >= similarity)
    )
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "words", "distance")).alias("b")
    return scored.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.start", "b.words", "b.distance", (-F.col("b.s")).alias("similarity"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without those that leak an item. Ids of leaking documents are few and stored, so Spark broadcasts them while they
    are; documents without an id stay."""
    bad = stored(leaks(docs, items).select(F.col("doc_id").alias("leaked")).distinct())
    return docs.join(bad, docs["doc_id"] == bad["leaked"], "left_anti")


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    from tidemark.llm.common import table

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
