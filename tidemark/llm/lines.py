"""Line de-duplication over levelled sorted runs, in SQL functions only.

Every line has a key, stripped and lower-cased, of which two 64-bit hashes are kept. Documents arrive in deliveries, largest
ids first. A delivery is counted by key and merge-anti-joined with the runs: a key that no run holds is new, and the
delivery's largest id keeps its lines; a key that some run holds only adds to its count. The delivery then becomes a run of
its own. Runs are bucketed and sorted by hash, so the anti-join reads the older runs in place; whenever a level has FANOUT
runs, they are merged into one of the next level, so there are at most FANOUT runs a level and a key is rewritten once a level.

Keys found in min_docs documents or more lose their lines everywhere but in the document that keeps them. Only hashes and
positions of long lines are shuffled for this; texts move once, to meet their lists of dropped positions. A document's
repeats of one line count once.

A null text is an empty one, an empty text one empty line. Rows that share an id are one document; rows without an id are
together one document, older than all others. Repeated rows each give a row. An empty table gives an empty one. Other columns
are not read.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, stored, table

BLANKS = " \t\n\x0b\f\r"
LEAST_CHARS, MIN_DOCS = 40, 5
DELIVERIES, FANOUT = 4, 2
KEY = ["h", "g"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def row_key(text: Column) -> Column:
    """Tells the texts apart that share an id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def long_lines(docs: DataFrame, id_col: str, text_col: str, least_chars: int) -> DataFrame:
    """Rows (doc_id, row, pos, h, g) of the lines whose key has at least least_chars code points."""
    text = F.col(text_col)
    placed = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(text).alias("row"), F.posexplode(lines_of(text)).alias("pos", "line"))
    stripped = placed.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.length("line") >= least_chars)
    keyed = stripped.select("doc_id", "row", "pos", F.translate("line", string.ascii_uppercase, string.ascii_lowercase).alias("key"))
    return keyed.select("doc_id", "row", "pos", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"))


class Runs:
    """Runs of (h, g, n, last): n documents hold the key, last is the largest id of the delivery that first held it, null in the
    rows of later deliveries. A run holds a key once."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame) -> str:
        """A table bucketed and sorted by hash in the shared folder, one file a bucket."""
        name = f"line_run_{uuid.uuid4().hex}"
        rows.repartition(self.buckets, *KEY).write.format("parquet").option("path", scratch(self.spark, "run")).bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name)
        return name

    def _forget(self, names: list[str]) -> None:
        for name in names:  # the files stay until the driver ends
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> None:
        """Adds a delivery's long lines (doc_id, h, g). Its documents must be none of those added before."""
        held = lines.select("doc_id", *KEY).distinct().groupBy(*KEY).agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
        name = self._write(held)
        if self.levels:
            own = name
            new = self.new_keys(self.spark.table(own))
            known = self.spark.table(own).join(new.select(*KEY), KEY, "left_anti").withColumn("last", F.lit(None).cast("long"))
            name = self._write(new.unionByName(known))
            self._forget([own])
        self._place(name, 0)

    def new_keys(self, held: DataFrame) -> DataFrame:
        """The rows of held whose key no run holds."""
        for run in self.tables():
            held = held.join(run.select(*KEY), KEY, "left_anti")
        return held

    def _place(self, name: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            merged = self._write(merge([self.spark.table(n) for n in full]))
            self._forget(full)
            self._place(merged, level + 1)

    def totals(self) -> DataFrame:
        """All keys with their counts and keepers, stored; the runs are given up."""
        total = stored(merge(self.tables()))
        self._forget([n for level in self.levels for n in level])
        self.levels = []
        return total


def merge(runs: list[DataFrame]) -> DataFrame:
    """One run of several; a key's keeper is in the one row that has it. Sorted runs meet in merge joins: a union of bucketed
    tables is no way, since Spark 4.1 takes it for bucketed too and then groups within its parts alone."""
    both = runs[0]
    for run in runs[1:]:
        other = run.select(*KEY, F.col("n").alias("n2"), F.col("last").alias("last2"))
        n = F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))
        both = both.join(other, KEY, "full_outer").select(*KEY, n.alias("n"), F.coalesce("last", "last2").alias("last"))
    return both


def without(lines: Column, dropped: Column) -> Column:
    """lines but for those at the sorted positions dropped, in one pass: the stretches between them are taken whole."""
    bounds = F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines)))
    stretch = lambda s, i: F.slice(s["lines"], F.get(s["bounds"], i) + 2, F.get(s["bounds"], i + 1) - F.get(s["bounds"], i) - 1)
    kept = lambda s: F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["bounds"]) - 2), lambda i: stretch(s, i)))
    return F.element_at(F.transform(F.array(F.struct(lines.alias("lines"), bounds.alias("bounds"))), kept), 1)  # split once, not at every stretch


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, min_docs: int = MIN_DOCS, deliveries: int = DELIVERIES, fanout: int = FANOUT) -> DataFrame:
    """Rows (doc_id, text, n_lines, n_dropped), one per input row: text is what is left of it."""
    lines = stored(long_lines(docs, id_col, text_col, least_chars))
    shares = [i / deliveries for i in range(1, deliveries)]
    cuts = lines.agg(F.percentile_approx("doc_id", shares, 1000)).first()[0] if shares else []
    bounds = sorted(set(cuts or []))
    runs = Runs(docs.sparkSession, fanout)
    nth = F.lit(0)  # ids under so many of the bounds; those without an id come last
    for bound in bounds:
        nth = nth + F.coalesce((F.col("doc_id") < bound).cast("int"), F.lit(1))
    for i in range(len(bounds) + 1):
        runs.add(lines.where(nth == i))
    frequent = runs.totals().where(F.col("n") >= min_docs).select(*KEY, "last")
    gone = lines.join(frequent, KEY).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    dropped = gone.groupBy(F.col("doc_id").alias("d"), F.col("row").alias("r")).agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    met = rows.join(dropped, F.col("doc_id").eqNullSafe(F.col("d")) & (row_key(F.col("text")) == F.col("r")), "left")
    left = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(without(lines_of(F.col("text")), F.col("dropped")), "\n"))
    return met.select("doc_id", left.alias("text"), F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"))


def op11_line_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE = f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
m AS (SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> f.last, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
