"""SimHash near-duplicates: fingerprints of word shingles, linked by multi-index hashing.

Texts are fingerprinted in Arrow batches; equal fingerprints collapse to one row before any join, so a large group of
copies costs one fingerprint. The 64 bits are cut into segments. Two fingerprints within the radius differ in at most
radius // segments bits of some segment, so each one looks up the small Hamming ball around each of its segment values
in the table of segment values, and the complete distance is checked inside the join. Of the two ends of a link, only
the one whose lowest flipped bit is 0 looks up, so half the ball is sent and no link is lost.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, cut, stored

SHINGLE, SEED, RADIUS, SEGMENTS = 4, 42, 4, 3
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def simhash(text: str | None, k: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text: a bit is set if it is set in over half of the shingles' XXH64; 0 without words.

    >>> simhash(""), simhash(None)
    (0, 0)
    """
    words = WORD.findall((text or "").encode("utf-8", "replace").translate(LOWER))
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= k:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = [0, *(ends[: n - k] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """Rows (id, key, fp): fp is the fingerprint's 64 bits as a signed long, key a digest of id and text. One row per input
    row, null texts as empty."""

    def run(batches):
        for b in batches:
            fps = np.fromiter((simhash(t, k) for t in b.column(2).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], names=["id", "key", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), row_key(id_col, text_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "id long, key long, fp long")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("key")


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def hamming_links(prints: DataFrame, radius: int = RADIUS, segments: int = SEGMENTS) -> DataFrame:
    """Links (a, b) between rows (fp, rep) of distinct fingerprints at most radius bits apart, each link once."""
    ball = radius // segments
    widths = [64 // segments + (i < 64 % segments) for i in range(segments)]
    masks, values, at = [], [], 0
    for s, width in enumerate(widths):
        value = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else F.col("fp")
        flips = [sum(1 << i for i in c) for r in range(ball + 1) for c in itertools.combinations(range(width), r)]
        masks.append(F.array(*[F.lit(m).cast("long") for m in flips]))
        values.append(F.struct(F.lit(s).alias("s"), value.alias("v"), masks[-1].alias("flips")))
        at += width
    parts = prints.select("fp", "rep", F.inline(F.array(*[F.struct(x["s"].alias("s"), x["v"].alias("v")) for x in values])))
    probes = (
        prints.select("fp", "rep", F.explode(F.array(*values)).alias("x"))
        .select("fp", "rep", F.col("x.s").alias("s"), F.col("x.v").alias("at"), F.explode("x.flips").alias("flip"))
        .where(F.expr("flip = 0 or (at & flip & -flip) = 0"))
        .select(F.col("fp").alias("a_fp"), F.col("rep").alias("a"), "s", F.expr("at ^ flip").alias("v"), (F.col("flip") == 0).alias("same"))
    )
    table = parts.select(F.col("fp").alias("b_fp"), F.col("rep").alias("b"), F.col("s").alias("t_s"), F.col("v").alias("t_v"))
    near = (F.col("s") == F.col("t_s")) & (F.col("v") == F.col("t_v")) & (F.bit_count(F.col("a_fp").bitwiseXOR(F.col("b_fp"))) <= radius) & (~F.col("same") | (F.col("a_fp") < F.col("b_fp")))
    return probes.join(table, near).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


NAMELESS = 1 << 62


def grouped(docs: DataFrame, name: Column, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Rows (id, key, fp, component), one per input row. Each fingerprint has a name, an aggregate of its rows' (id, key, fp);
    a component has the smallest of its fingerprints' names."""
    rows = cut(fingerprints(docs, id_col, text_col, k))
    prints = cut(rows.groupBy("fp").agg(name.alias("rep")))
    found = components(hamming_links(prints, radius))
    named = prints.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return rows.join(named, "fp").select("id", "key", "fp", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row (id, fp, component) per input row; component is the smallest id whose text is reachable by links.

    Null or empty texts share fingerprint 0. Repeated rows stay repeated. A null id gets a component but names none: where no
    row of a component has an id, the component is null. An empty table gives an empty one; other columns are not read.

    Fingerprints of rows without an id are named by a number from NAMELESS on, over every id; two that share such a number
    differ in two bits at most, so they are linked anyway.
    """
    name = F.coalesce(F.min("id"), F.lit(NAMELESS) + F.shiftrightunsigned(F.first("fp"), 2))
    return grouped(docs, name, id_col, text_col, k, radius).select("id", "fp", F.when(F.col("component") < NAMELESS, F.col("component")).alias("component"))


def op4_simhash(spark, sf_dir: str) -> DataFrame:
    from tidemark.llm.common import table

    return near_duplicates(table(spark, sf_dir, "documents")).select(F.col("id").alias("doc_id"), hex16(F.col("fp")).alias("fingerprint"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group: the one of the smallest doc_id, of equal ids the one of the smallest key, documents without
    an id only where no document of the group has one. Of rows equal in id and text one stays.

    Only ids and keys are grouped; the rows to leave out, the smaller part, are taken away from docs by their keys."""
    found = cut(grouped(docs, F.min("fp")).groupBy("id", "key", "component").agg(F.count("*").alias("n")))
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "key"))
    kept = found.groupBy("component").agg(first.alias("f")).select("f.key")
    dropped = found.join(kept, "key", "left_anti").select("key").distinct()
    out = _without(docs, stored(dropped))
    repeated = stored(found.where("n > 1").select("key").distinct())
    if not repeated.limit(1).count():
        return out
    return _without(out, repeated).unionByName(_within(out, repeated).dropDuplicates(["doc_id", "text"]))


def _without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return docs.join(keys.withColumnRenamed("key", "_key"), row_key() == F.col("_key"), "left_anti")


def _within(docs: DataFrame, keys: DataFrame) -> DataFrame:
    return docs.join(keys.withColumnRenamed("key", "_key"), row_key() == F.col("_key"), "left_semi")
