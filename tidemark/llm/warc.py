"""WARC archives with payload deduplication, and one globally ordered index of their captures.

Writing: ids and digests are grouped apart from the payloads, which are not shuffled: each row learns from the small table of
revisits whether it is one. Spark's text writer puts one record a row, the record separator being its line separator, in gzip
files of at most FILE_BYTES: pages of up to SMALL_BYTES lie FILE_RECORDS to a file, larger ones so many as fit by the largest.
Reading: archives are parsed record by record by their lengths. Index: each task sorts the captures that it reads into a run,
written to the shared folder; ranges of (URL key, time, record, place in the archives) of about RANGE_ROWS captures are dealt
out, Spark's own sort brings each range's runs one after the other, and a loser tree merges them from Arrow batches, of which
HEAD_ROWS rows over all runs are unpacked at a time. So the parts in order are one ordered history, a task's memory is bounded
by a range whatever the input, and a host, an URL or a record that holds most captures is still cut into many ranges.

A null payload is an empty one; a null URL gives an empty key; rows without an id are written but refer to nothing and are
referred to by nothing; rows that repeat the smallest id of a payload are all responses; an empty table gives no archive's
records. Other columns are not read. An archive that ends within a record is an error.
"""

from __future__ import annotations

import hashlib
import zlib
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch, stored, table

LEAST_BYTES, FILE_RECORDS, SMALL_BYTES, FILE_BYTES = 100, 1000, 1 << 18, 1 << 28
RANGE_ROWS, HEAD_ROWS = 50_000, 1 << 16
NO_TIME = "1970-01-01T00:00:00Z"
URN = "urn:capture:"
RUN_SCHEMA = "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, archive string, offset long, length long, run long, place long"
INDEX_SCHEMA = RUN_SCHEMA.rsplit(", run", 1)[0] + ", part long, place long, nth long"


def decided(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", time_col: str | None = None, least_bytes: int = LEAST_BYTES) -> tuple[DataFrame, int]:
    """Rows (page_id, url, captured, html, payload_bytes, payload_digest, first), first being the smallest id of those with an
    equal payload of at least least_bytes, null where that is the row's own id or the payload is smaller; and the bytes of the
    largest payload."""
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col(url_col).cast("string"), F.lit("")), r"[\r\n]", "").alias("url"),
        (F.date_format(F.col(time_col), "yyyy-MM-dd'T'HH:mm:ss'Z'") if time_col else F.lit(NO_TIME)).alias("captured"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    ).withColumns({"payload_bytes": F.octet_length("html").cast("long"), "payload_digest": F.sha2("html", 256)})
    known = stored(rows.select("page_id", "payload_bytes", "payload_digest"))
    largest = known.agg(F.max("payload_bytes")).first()[0] or 0
    shared = known.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first < last")
    # the digests that ids share are a part of all; an id that comes twice with two payloads keeps both
    revisits = stored(known.join(shared, "payload_digest").where("page_id <> first").select("page_id", "payload_digest", "first").distinct())
    return rows.join(revisits, ["page_id", "payload_digest"], "left"), largest


def record(row: DataFrame) -> Column:
    """Header and block of one row's record, without the separator that ends it."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    revisit = F.col("first").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    urn = lambda c: F.concat(F.lit(f"<{URN}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.col("captured")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("first"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
    )
    return F.concat(head, line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write(pages: DataFrame, path: str, **columns) -> None:
    """Archives of pages at path."""
    rows, largest = decided(pages, **columns)

    def put(part: DataFrame, records: int, mode: str) -> None:
        part.select(record(part).alias("value")).write.mode(mode).option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records).text(path)

    put(rows.where(F.col("payload_bytes") <= SMALL_BYTES), FILE_RECORDS, "error")
    if largest > SMALL_BYTES:
        put(rows.where(F.col("payload_bytes") > SMALL_BYTES), max(1, FILE_BYTES // largest), "append")


def inflate(data: bytes) -> bytes:
    """The content of all gzip members; data that isn't compressed as it is."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        z = zlib.decompressobj(31)
        out.append(z.decompress(data))
        out.append(z.flush())
        data = z.unused_data
    return b"".join(out)


def records(data: bytes):
    """(headers, block, offset, length) of each record of an archive."""
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError(f"the archive ends within the record at {at}")
        headers = {}
        for part in data[at:end].split(b"\r\n")[1:]:
            name, _, value = part.partition(b":")
            headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        stop = end + 4 + int(headers.get("content-length", 0))
        if stop > len(data):
            raise ValueError(f"the archive ends within the record at {at}")
        yield headers, data[end + 4 : stop], at, stop - at
        at = stop


def number(urn: str | None) -> int | None:
    text = (urn or "").strip("<>").removeprefix(URN)
    return int(text) if text.lstrip("-").isdigit() else None


def url_key(url: str) -> str:
    """Host labels from the last to the first, then the path and query: captures of a site stand together.

    >>> url_key("https://www.Example.com:443/a/b?c=1#top")
    'com,example)/a/b?c=1'
    """
    try:
        u = urlsplit(url)
        host = u.hostname or ""
    except ValueError:
        return url
    labels = host.removeprefix("www.").split(".")[::-1]
    return ",".join(labels) + ")" + (u.path or "/") + ("?" + u.query if u.query else "")


def order(c: tuple) -> tuple:
    return c[0], c[1], c[2] is not None, c[2] or 0, c[8], c[9]


def runs(spark, path: str) -> DataFrame:
    """Captures of the archives at path, each batch that a task reads sorted into a run. A response's payload is hashed
    again and must have its stated digest."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def parse(batches):
        for nth, b in enumerate(batches):
            found = []
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for head, block, offset, length in records(inflate(data)):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    kind, digest = head["warc-type"], head["warc-payload-digest"].removeprefix("sha256:")
                    if kind == "revisit":
                        size = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length")).split(b":")[1])
                    else:
                        size = len(payload)
                        if hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"{name}: the record at {offset} does not have its digest")
                    url = head.get("warc-target-uri", "")
                    found.append((url_key(url), head["warc-date"], number(head["warc-record-id"]), size, digest, kind, number(head.get("warc-refers-to")), url, name, offset, length))
            found.sort(key=order)
            run = TaskContext.get().partitionId() * 1_000_000 + nth
            yield batch([(*c, run, i) for i, c in enumerate(found)], RUN_TYPES)

    return files.mapInArrow(parse, RUN_SCHEMA)


RUN_TYPES, INDEX_TYPES = ([(n, {"string": pa.string(), "long": pa.int64()}[t]) for n, t in (x.split(" ") for x in s.split(", "))] for s in (RUN_SCHEMA, INDEX_SCHEMA))


def batch(rows: list[tuple], types) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, types)], names=[n for n, _ in types])


class LoserTree:
    """Merges k sorted streams: inner nodes hold the losers of the matches below, so each next item costs one path of
    about log2 k matches, and of each stream one item is held.

    >>> list(LoserTree([[1, 4], [], iter([2, 3])], key=lambda x: x))
    [1, 2, 3, 4]
    """

    def __init__(self, streams, key):
        self.key, self.streams, self.items, self.heads = key, [], [], []
        for s in map(iter, streams):
            for item in s:
                self.streams.append(s)
                self.items.append(item)
                self.heads.append(key(item))
                break
        self.k = len(self.streams)
        self.losers = [-1] * max(1, self.k)
        self.winner = self._build(1) if self.k else -1

    def _beats(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[a] is not None
        return (self.heads[a], a) < (self.heads[b], b)

    def _build(self, node: int) -> int:
        if node >= self.k:
            return node - self.k
        a, b = self._build(2 * node), self._build(2 * node + 1)
        won, lost = (a, b) if self._beats(a, b) else (b, a)
        self.losers[node] = lost
        return won

    def __iter__(self):
        while self.k and self.heads[w := self.winner] is not None:
            yield self.items[w]
            self.items[w] = next(self.streams[w], None)
            self.heads[w] = None if self.items[w] is None else self.key(self.items[w])
            node = (w + self.k) // 2
            while node:
                if self._beats(self.losers[node], w):
                    self.losers[node], w = w, self.losers[node]
                node //= 2
            self.winner = w


def by_run(batches, column: int) -> dict[int, list[pa.RecordBatch]]:
    """Slices of batches that come ordered by run, by run; nothing is copied or unpacked."""
    found: dict[int, list[pa.RecordBatch]] = {}
    for b in batches:
        ends = b.column(column).to_numpy()
        cuts = [0, *(np.flatnonzero(ends[1:] != ends[:-1]) + 1).tolist(), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                found.setdefault(int(ends[lo]), []).append(b.slice(lo, hi - lo))
    return found


def rows_of(slices: list[pa.RecordBatch], step: int):
    """Rows of one run as tuples, so many unpacked at a time."""
    for b in slices:
        for lo in range(0, b.num_rows, step):
            yield from zip(*(c.to_pylist() for c in b.slice(lo, step).columns))


def merged(captures: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The captures of all runs in order of (url_key, captured, page_id, archive, offset), with the part, the place
    within it, and how many of its URL it is there: parts are numbered in order. captures should be stored; they are counted first."""
    n = len(RUN_TYPES) - 2
    ranges = captures.sparkSession.sparkContext.defaultParallelism + captures.count() // range_rows

    def merge(batches):
        runs = by_run(batches, n)
        part, step = TaskContext.get().partitionId(), max(16, HEAD_ROWS // max(1, len(runs)))
        out, place, nth, url = [], 0, 0, None
        for row in LoserTree([rows_of(slices, step) for slices in runs.values()], order):
            nth, url = nth + 1 if row[0] == url else 1, row[0]
            out.append((*row[:n], part, place, nth))
            place += 1
            if len(out) == 10_000:
                yield batch(out, INDEX_TYPES)
                out = []
        yield batch(out, INDEX_TYPES)

    dealt = captures.repartitionByRange(ranges, "url_key", "captured", "page_id", "archive", "offset")
    return dealt.sortWithinPartitions("run", "place").mapInArrow(merge, INDEX_SCHEMA)


def index(spark, path: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The ordered index of the archives at path. Runs are written once, so finding the ranges reads no archive again."""
    return merged(stored(runs(spark, path)), range_rows)


def positioned(ordered: DataFrame) -> DataFrame:
    """The index with each capture's position, from 1, in the whole history, and in its URL's (nth_of_url). Both are the numbers
    within the part, shifted by what windows over one row a part say of the parts before; captures of one URL stand together, so
    only the first URL of a part can have begun before it, and a URL that holds most captures meets in no task."""
    rows = stored(ordered)
    parts = rows.groupBy("part").agg(F.count("*").alias("n"), F.min_by("url_key", "place").alias("first_url"), F.max_by("url_key", "place").alias("last_url"), F.max_by("nth", "place").alias("n_last"))
    in_order = Window.orderBy("part")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumns({"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "goes_on": F.coalesce(F.col("first_url") == F.lag("last_url").over(in_order), F.lit(False))})
    began = F.when(~(F.col("goes_on") & (F.col("n_last") == F.col("n"))), F.col("before") + F.col("n") - F.col("n_last") + 1)
    parts = parts.withColumn("began", began).select("part", "before", F.when(F.col("goes_on"), F.last("began", ignorenulls=True).over(earlier)).alias("since"))
    start = F.when(F.col("nth") == F.col("place") + 1, F.col("since"))  # of the part's first URL
    position = F.col("before") + F.col("place") + 1
    numbered = rows.join(F.broadcast(parts), "part").withColumns({"position": position, "nth_of_url": F.coalesce(position - start + 1, F.col("nth"))})
    return numbered.drop("part", "place", "nth", "before", "since")


def op10_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write(table(spark, sf_dir, "pages"), path)
    return positioned(index(spark, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "position", "nth_of_url")


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, coalesce(url, '') AS url FROM pages),
d AS (SELECT page_id, url, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest),
u AS (SELECT *, regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)(:[0-9]*)?([^?#]*)(\?[^#]+)?', ['host', 'port', 'path', 'query']) AS x FROM d),
k AS (SELECT *, array_to_string(list_reverse(string_split(regexp_replace(lower(x.host), '^www\.', ''), '.')), ',') || ')' || CASE WHEN x.path = '' THEN '/' ELSE x.path END || x.query AS url_key FROM u)
SELECT k.page_id, k.payload_bytes, k.payload_digest,
       CASE WHEN f.first <> k.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> k.page_id THEN f.first END AS refers_to,
       url_key, row_number() OVER (ORDER BY url_key, k.page_id) AS position, row_number() OVER (PARTITION BY url_key ORDER BY k.page_id) AS nth_of_url
FROM k LEFT JOIN f USING (payload_digest)
"""
