"""Near-duplicate vectors by NN-descent.

Equal vectors collapse to one representative first. A neighbour graph starts from random hyperplane buckets, cut into chunks
of bounded size, and is refined: each vector's forward and reverse neighbours are compared with one another where at least
one of the two is new to the list, and better ones replace worse ones, until few lists change. Pairs at or over the threshold
are links. A list that is full of links is saturated and may lack some: it is enlarged to all members of its component, which
are compared block by block and counted without being listed. An audit compares a fixed set of vectors with all rows; if it finds links that the
graph lacks, further rounds start from other hyperplanes. The share of the audited links that was found is a column of the
result; a warning is logged where it stays under RECALL.

Cosines are worked out in double precision from the vectors as given, each first divided by a power of two, so that neither
huge nor tiny ones leave the range. Null vectors, zero vectors and vectors with null or non-finite parts link with nothing;
vectors of different lengths do not link; rows without an id are left out; repeated ids count once, with their smallest
vector; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import logging

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import components, cut, stored, table

THRESHOLD, LIST, CHUNK, PLANES, REVERSE = 0.9, 10, 128, 8, 40
DESCENTS, CHANGED, ROUNDS, AUDITED, RECALL, BLOCK = 8, 0.002, 6, 256, 0.999, 512
DEALT = 8
LOG = logging.getLogger(__name__)
PAIRS = "u long, v long, sim double"


def by_group(df: DataFrame, key: str, schema: str, work) -> DataFrame:
    """work(columns of one group as a dict) for each value of key; it yields record batches. Rows of a key come together
    by a shuffle and a sort, one group at a time is held."""
    names = df.columns
    at = names.index(key)

    def run(batches):
        held = []
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(at).to_numpy(zero_copy_only=False)
            starts = [0, *(np.nonzero(keys[1:] != keys[:-1])[0] + 1).tolist()]
            for i, a in enumerate(starts):
                end = starts[i + 1] if i + 1 < len(starts) else b.num_rows
                if held and held[0].column(at)[0].as_py() != keys[a]:
                    yield from work(pa.Table.from_batches(held))
                    held = []
                held.append(b.slice(a, end - a))
        if held:
            yield from work(pa.Table.from_batches(held))

    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)


def matrix(column) -> np.ndarray:
    """Rows of unit length in double precision."""
    parts = column.to_pylist()
    x = np.stack([_vector(p) for p in parts])
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _vector(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[1:], np.float64 if raw[:1] == b"d" else np.float32).astype(np.float64)


def batch(u, v, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float64())], names=["u", "v", "sim"])


def prepared(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows (id, d, x): x the vector's bytes with a letter for their width, d their digest; both null for vectors that link
    with nothing."""

    def run(batches):
        for b in batches:
            col = b.column(1)
            wide = b"d" if pa.types.is_float64(col.type.value_type) else b"f"
            flat, ends, ok = col.values.to_numpy(zero_copy_only=False), col.offsets.to_numpy(), col.is_valid().to_numpy(zero_copy_only=False)
            xs = []
            for i in range(b.num_rows):
                v = flat[ends[i] : ends[i + 1]]
                top = np.abs(v).max() if ok[i] and len(v) else 0.0  # not a number if one part is none
                xs.append(wide + np.ldexp(v, -int(np.frexp(top)[1])).tobytes() if 0 < top < np.inf else None)
            ds = [x and hashlib.blake2b(x, digest_size=16).digest() for x in xs]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ds, pa.binary()), pa.array(xs, pa.binary())], names=["id", "d", "x"])

    kind = rows.schema[vec_col].dataType.simpleString()
    vec = F.col(vec_col) if kind in ("array<float>", "array<double>") else F.col(vec_col).cast("array<double>")
    chosen = rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), vec.alias("vec"))
    return chosen.mapInArrow(run, "id long, d binary, x binary")


def seeds(vectors: DataFrame, bits: int, seed: int, keep: int) -> DataFrame:
    """Pairs from random buckets: for each of PLANES hashes, vectors with equal signs against `bits` random planes."""

    def sign(batches):
        for b in batches:
            if not b.num_rows:
                continue
            raw = b.column(1).to_pylist()
            for p in range(PLANES):
                out = []
                cache: dict[int, np.ndarray] = {}
                for r in raw:
                    v = _vector(r)
                    if len(v) not in cache:
                        cache[len(v)] = np.random.default_rng([seed, p, len(v)]).normal(size=(len(v), bits))
                    out.append((len(v) * PLANES + p, int((v @ cache[len(v)] > 0) @ (1 << np.arange(bits)))))
                yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in zip(*out))], names=["id", "plane", "sign"])

    signs = cut(vectors.select("id", "x").mapInArrow(sign, "id long, plane long, sign long").select("id", F.xxhash64("plane", "sign").alias("bucket")))
    sizes = signs.groupBy("bucket").agg(F.ceil(F.count("*") / CHUNK).alias("n")).where("n > 1")
    chunks = signs.join(sizes, "bucket", "left").select("id", F.xxhash64("bucket", F.when(F.col("n") > 1, F.pmod(F.xxhash64("id", "bucket"), F.col("n"))).otherwise(F.lit(0).cast("long"))).alias("chunk"))

    def best(group):
        ids, x = group["id"].to_numpy(), matrix(group["x"])
        n = len(ids)
        if n < 2:
            return
        s = x @ x.T
        np.fill_diagonal(s, -2)
        k = min(keep, n - 1)
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        yield batch(np.repeat(ids, k), ids[top.ravel()], np.take_along_axis(s, top, 1).ravel())

    return by_group(chunks.join(vectors.select("id", "x"), "id").select("chunk", "id", "x"), "chunk", PAIRS, best)


def trimmed(pairs: DataFrame, size: int) -> DataFrame:
    """The `size` nearest of each list; an entry found again keeps the flag that it had."""
    one = pairs.repartition("u").groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("new").alias("new"))
    return one.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))).where(F.col("rank") <= size).drop("rank")


def descend(vectors: DataFrame, graph: DataFrame, size: int) -> DataFrame:
    """Better neighbours from one local join over the graph (u, v, sim, new)."""
    both = graph.select("u", "v", "new").unionByName(graph.select(F.col("v").alias("u"), F.col("u").alias("v"), "new")).groupBy("u", "v").agg(F.max("new").alias("new"))
    around = both.groupBy("u").agg(F.max("new").alias("any"), F.ceil(F.count("*") / (size + REVERSE)).cast("int").alias("n")).where("any")
    members = both.join(around, "u").select("u", F.pmod(F.xxhash64("u", "v"), F.col("n")).cast("int").alias("part"), "n", "v", "new")
    # a hub's list is dealt to several groups; what is new goes to DEALT of them, so it meets all of a list of so many groups
    more = F.transform(F.sequence(F.lit(0), F.least(F.col("n"), F.lit(DEALT)) - 1), lambda i: (F.col("part") + i) % F.col("n"))
    spread = members.withColumn("part", F.explode(F.when(F.col("new") & (F.col("n") > 1), more).otherwise(F.array("part"))))
    lows = graph.groupBy("u").agg(F.when(F.count("*") >= size, F.min("sim")).otherwise(F.lit(-2.0)).alias("low")).withColumnRenamed("u", "id")
    known = vectors.select("id", "x").join(lows, "id", "left").withColumnRenamed("id", "v")
    joined = spread.join(known, "v").select(F.xxhash64("u", "part").alias("g"), F.col("v").alias("id"), "x", F.coalesce("low", F.lit(-2.0)).alias("low"), "new")

    def local(group):
        ids, low, new = group["id"].to_numpy(), group["low"].to_numpy(), group["new"].to_numpy(zero_copy_only=False)
        if len(ids) < 2:
            return
        x = matrix(group["x"])
        s = x @ x.T
        ok = (s > low[:, None]) & (new[:, None] | new[None, :])
        np.fill_diagonal(ok, False)
        if not ok.any():
            return
        if len(ids) > size + 1:
            worst = np.partition(np.where(ok, s, -2), -size, axis=1)[:, -size]
            ok &= s >= worst[:, None]
        i, j = np.nonzero(ok)
        yield batch(ids[i], ids[j], s[i, j])

    return by_group(joined, "g", PAIRS, local)


def neighbour_graph(vectors: DataFrame, n: int, seed: int, size: int, start: DataFrame | None = None) -> DataFrame:
    """Lists (u, v, sim, new) of up to `size` neighbours."""
    bits = max(1, int(np.ceil(np.log2(max(2, n / (CHUNK / 2))))))
    found = seeds(vectors, bits, seed, size // 2).withColumn("new", F.lit(True))
    graph = cut(trimmed(found if start is None else found.unionByName(start.withColumn("new", F.lit(False))), size))
    for _ in range(DESCENTS):
        better = descend(vectors, graph, size).withColumn("new", F.lit(True))
        graph = cut(trimmed(graph.withColumn("new", F.lit(False)).unionByName(better), size))
        if graph.where("new").count() <= CHANGED * size * n:
            break
    return graph


def dense_links(vectors: DataFrame, members: DataFrame, threshold: float) -> DataFrame:
    """Rows (id, links): for members (id, component, n) of components with saturated lists, the weight of all vectors of the
    component at or over the threshold, the vector itself left out. Components are compared in blocks of about BLOCK."""
    rows = members.join(vectors, "id").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("b", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    sides = rows.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = sides.select(F.xxhash64("component", F.least("b", "o"), F.greatest("b", "o")).alias("g"), "id", "m", "x", (F.col("b") == F.least("b", "o")).alias("first"), (F.col("b") == F.col("o")).alias("same"))

    def count(group):
        ids, m, x = group["id"].to_numpy(), group["m"].to_numpy().astype(np.int64), matrix(group["x"])
        first, same = group["first"].to_numpy(zero_copy_only=False), bool(group["same"][0].as_py())
        if same:
            links = (x @ x.T >= threshold).astype(np.int64)
            np.fill_diagonal(links, 0)
            add = links @ m
        else:
            a, b = np.nonzero(first)[0], np.nonzero(~first)[0]
            add = np.zeros(len(ids), np.int64)
            if len(a) and len(b):
                links = (x[a] @ x[b].T >= threshold).astype(np.int64)
                add[a], add[b] = links @ m[b], links.T @ m[a]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(add)], names=["id", "links"])

    return by_group(keyed, "g", "id long, links long", count).groupBy("id").agg(F.sum("links").alias("links"))


def audit(vectors: DataFrame, threshold: float, queries: int = AUDITED) -> DataFrame:
    """Rows (id, links, u, v): the true links of a fixed set of vectors (at most `queries` of them go out), against all rows."""
    asked = vectors.select("id", "x").orderBy(F.xxhash64("id", F.lit(17)), "id").limit(queries).collect()
    ids = np.array([r["id"] for r in asked])
    groups: dict[int, list[int]] = {}
    for i, r in enumerate(asked):
        groups.setdefault(len(_vector(bytes(r["x"]))), []).append(i)
    mats = {k: (ids[i], matrix(pa.array([bytes(asked[j]["x"]) for j in i]))) for k, i in groups.items()}

    def scan(batches):
        for b in batches:
            raw, own, m = b.column(1).to_pylist(), b.column(0).to_numpy(), b.column(2).to_numpy()
            sizes = np.array([len(_vector(r)) for r in raw])
            for k, (qs, q) in mats.items():
                mine = np.nonzero(sizes == k)[0]
                if len(mine):
                    s = q @ matrix(pa.array([raw[i] for i in mine])).T
                    i, j = np.nonzero((s >= threshold) & (qs[:, None] != own[mine][None, :]))
                    yield pa.RecordBatch.from_arrays([pa.array(qs[i]), pa.array(own[mine][j]), pa.array(s[i, j]), pa.array(m[mine][j])], names=["u", "v", "sim", "m"])

    return vectors.select("id", "x", "m").mapInArrow(scan, PAIRS + ", m long")


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD, size: int = LIST) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept, audited_recall) per id."""
    full = stored(prepared(rows, id_col, vec_col))
    every = cut(full.groupBy("id").agg(F.min("d").alias("d")))
    groups = full.where("d is not null").join(every, ["id", "d"], "left_semi").groupBy("d").agg(F.min("id").alias("id"), F.count_distinct("id").alias("m"), F.min("x").alias("x"))
    vectors = stored(groups)
    n = vectors.count()
    graph, links, named, counted, recall = None, None, None, None, 1.0
    for round_ in range(ROUNDS if n else 0):
        graph = neighbour_graph(vectors, n, 1000 + round_, size, graph if graph is None else graph.drop("new"))
        near = graph.where(F.col("sim") >= threshold)
        if links is not None:  # links of rounds before may have left the lists
            near = near.select("u", "v").unionByName(links)
        links = cut(near.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
        named = components(links.select(F.col("u").alias("a"), F.col("v").alias("b")))
        named = cut(named)
        full_lists = graph.where(F.col("sim") >= threshold).groupBy(F.col("u").alias("id")).count().where(F.col("count") >= size)
        dense = full_lists.join(named, "id").select("component").distinct()
        inside = named.join(dense, "component", "left_semi")
        members = inside.join(inside.groupBy("component").agg(F.count("*").alias("n")), "component")
        ends = links.select(F.col("u").alias("id"), F.col("v").alias("other")).unionByName(links.select(F.col("v").alias("id"), F.col("u").alias("other")))
        sparse = ends.join(members.select("id"), "id", "left_anti").join(vectors.select(F.col("id").alias("other"), "m"), "other").groupBy("id").agg(F.sum("m").alias("links"))
        counted = cut(sparse.unionByName(dense_links(vectors, members, threshold)))
        truth = audit(vectors, threshold).groupBy(F.col("u").alias("id")).agg(F.sum("m").alias("true"))
        there, have = truth.join(counted, "id", "left").agg(F.coalesce(F.sum("true"), F.lit(0)), F.coalesce(F.sum(F.least("true", F.coalesce("links", F.lit(0)))), F.lit(0))).first()
        LOG.info("round %d: %d of %d audited links found", round_, have, there)
        recall = have / there if there else 1.0
        if recall >= RECALL:
            break
    else:
        if n:
            LOG.warning("%.4f of the audited links were found", recall)
    if named is None:
        return every.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"), F.lit(1.0).alias("audited_recall"))
    result = (
        vectors.select("d", F.col("id").alias("rep"), "m")
        .join(named.withColumnRenamed("id", "rep"), "rep", "left")
        .join(counted.withColumnRenamed("id", "rep"), "rep", "left")
        .select("d", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    )
    out = every.join(result, "d", "left").select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    return out.withColumns({"kept": F.col("vec_id") == F.col("component_id"), "audited_recall": F.lit(float(recall))})


def op1_neighbours(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
