"""Alignment of two tokenizers' tokens over the bytes of a text, by interval coalescing.

A: byte-level BPE of space + text. B: sentencepiece BPE of text, which adds the space itself. The tokens of both, as byte
intervals, are sorted by start (lexsort), and the running maximum of their ends is taken (maximum.accumulate): where a start
reaches the maximum of what stands before, both tokenizers have ended, and a new group begins. Within each group overlapping
A and B tokens are expanded to pairs; those that end together are links.

A text is cut before each blank that follows something other than white space. Neither tokenizer's tokens cross such a cut (checked when the
vocabularies are read), so each kind of stretch is aligned once for each block of texts.
Links are counted by block and pair of ids, so a frequent pair sends one row a block; the corpus-wide counts return to the
block by one row a pair, where its documents add them up. A block is a bounded run of texts, or one long text.

A null or empty text, and one that either tokenizer doesn't give back byte for byte, has no tokens: zeros and empty groups.
Repeated rows and null ids each give a row. An empty table gives an empty one. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import byte_letters
from tidemark.llm.common import stored, table

FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_CHARS, BLOCK_ROWS, RUN, SLICE = 4_000_000, 20_000, 50, 500
BREAKS = "".join(map(chr, [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))  # white space but for the blank
STRETCH = re.compile(f"[ {BREAKS}]*[^ {BREAKS}]+(?:[{BREAKS}][ {BREAKS}]*[^ {BREAKS}]*)*|[ {BREAKS}]+")
CROSSES = re.compile(f"[^ {BREAKS}] ")


def coalesce(starts: np.ndarray, ends: np.ndarray, is_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order, group of each interval in that order, a, b): the intervals of both sides sorted by start, their groups, and the
    overlapping pairs of an A and a B interval as places in the input. Intervals of a side don't overlap each other."""
    order = np.lexsort((is_b, starts))
    s, e, side = starts[order], ends[order], is_b[order]
    reach = np.maximum.accumulate(e)
    begins = np.r_[True, s[1:] >= reach[:-1]] if len(s) else np.zeros(0, bool)
    group = np.cumsum(begins) - 1
    # an A interval meets the B intervals from the first that ends behind its start to the last that starts before its end;
    # both sides are in order, so these lie within its group
    a, b = order[side == 0], order[side == 1]
    first = np.searchsorted(ends[b], starts[a], side="right")
    many = np.maximum(np.searchsorted(starts[b], ends[a], side="left") - first, 0)
    return order, group, np.repeat(a, many), b[spread(first, many)]


class Alignment(NamedTuple):
    """The kinds of stretch that come back whole and those that don't; of each of the former its numbers of tokens, groups,
    overlapping pairs and links, and its groups as text, each closed by a semicolon; and the links' pairs of ids, end to end."""

    kinds: list[str]
    lost: list[str]
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_overlaps: np.ndarray
    n_links: np.ndarray
    links: np.ndarray
    texts: list[str]


class Aligner:
    """Both tokenizers and their tokens' bytes."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = {letter: i for i, letter in enumerate(byte_letters())}
        size = self.a.get_vocab_size()
        names = [self.a.id_to_token(i) for i in range(size)]
        self.bytes_a = [bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode() for t in names]
        b = self.b
        self.bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
        self.len_a, self.len_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # cuts hold if no token of either has a blank behind another character; A splits there before it merges
        self.cuts = not any(CROSSES.search(x.decode("utf-8", "ignore")) for x in [*self.bytes_a, *self.bytes_b])
        self.lead = b.encode("a")
        self.cuts &= len(self.lead) == 1
        self.marked = [f"{i}{m}" for i in range(max(size, len(self.bytes_b))) for m in ",|;"]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """A's ids. What its library says besides ids is large, so texts go slice by slice."""
        return [x.ids for at in range(0, len(texts), SLICE) for x in self.a.encode_batch_fast(texts[at : at + SLICE], add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """B's ids of texts as they stand. B adds a space of its own, so a text that doesn't start with one is read behind a letter
        whose token is taken off again."""
        plain = [x.startswith(" ") and len(x) > 1 for x in texts]
        ids = self.b.encode([x[1:] if p else "a" + x for x, p in zip(texts, plain)], num_threads=1)
        return [x if p else x[1:] for x, p in zip(ids, plain)]

    def whole(self, text: str, ids_a: list[int], ids_b: list[int]) -> bool:
        """Whether both sides give a text back byte for byte."""
        raw = text.encode()
        return all(b"".join(map(names.__getitem__, ids)) == raw for names, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b)))

    def tokens(self, stretches: list[str]) -> tuple[list[str], list[str], list[np.ndarray], list[np.ndarray]]:
        """(kinds, lost, [ids of A, of B], [how many of each kind]): the stretches that come back whole, those that don't, and the
        tokens of the former, end to end. Stretches that can stand behind one another are encoded in runs of RUN; a run that
        doesn't come back whole is encoded one by one, as are the others."""
        joined = [s for s in stretches if s[0] == " " and len(s) > 1 and s[-1] != " " and s[-1] not in BREAKS] if self.cuts else []
        alone = list(set(stretches).difference(joined))
        runs = [joined[i : i + RUN] for i in range(0, len(joined), RUN)]
        texts = ["".join(r) for r in runs]
        kinds, lost, ids_a, ids_b = [], [], [], []
        for run, text, x, y in zip(runs, texts, self.encode_a(texts), self.encode_b(texts)):
            if self.whole(text, x, y):
                kinds += run
                ids_a.append(x)
                ids_b.append(y)
            else:
                alone += run
        for s, x, y in zip(alone, self.encode_a(alone), self.encode_b(alone)):
            if self.whole(s, x, y):
                kinds.append(s)
                ids_a.append(x)
                ids_b.append(y)
            else:
                lost.append(s)
        flat = [np.fromiter(chain.from_iterable(x), np.int64) for x in (ids_a, ids_b)]
        ends = np.cumsum(np.fromiter((len(s.encode()) for s in kinds), np.int64, len(kinds)))
        counts = []
        for ids, lengths in zip(flat, (self.len_a, self.len_b)):
            reach = np.cumsum(lengths[ids])
            upto = np.searchsorted(reach, ends) + 1  # a token ends where the kind does
            assert (reach[upto - 1] == ends).all()
            counts.append(np.diff(upto, prepend=0))
        return kinds, lost, flat, counts

    def align(self, stretches: list[str]) -> Alignment:
        """Groups and links of stretches, all coalesced together: each lies behind the one before."""
        kinds, lost, (flat_a, flat_b), (n_a, n_b) = self.tokens(stretches)
        # joined bytes are the same on both sides, so both sides' ends run on from stretch to stretch alike
        ends_a, ends_b = np.cumsum(self.len_a[flat_a]), np.cumsum(self.len_b[flat_b])
        ends = np.concatenate([ends_a, ends_b])
        starts = np.concatenate([ends_a - self.len_a[flat_a], ends_b - self.len_b[flat_b]])
        is_b = np.repeat(np.array([0, 1], np.int8), [len(flat_a), len(flat_b)])
        order, group, left, right = coalesce(starts, ends, is_b)
        together = ends[left] == ends[right]
        owner = np.concatenate([np.repeat(np.arange(len(kinds)), n) for n in (n_a, n_b)])
        count = lambda of: np.bincount(of, minlength=len(kinds))
        links = flat_a[left[together]] << 16 | flat_b[right[together] - len(flat_a)]
        first = np.r_[True, group[1:] != group[:-1]] if len(group) else np.zeros(0, bool)
        return Alignment(kinds, lost, n_a, n_b, count(owner[order[first]]), count(owner[left]), count(owner[left[together]]), links, self._texts(order, group, is_b, np.concatenate([flat_a, flat_b]), n_a + n_b))

    def _texts(self, order, group, is_b, flat, sizes) -> list[str]:
        """Each stretch's groups as text: a group's A ids, then its B ids, each id with the mark that follows it."""
        by = order[np.lexsort((is_b[order], group))]
        of = np.empty(len(order), np.int64)
        of[order] = group
        side = 2 * of[by] + is_b[by]
        last = np.r_[side[1:] != side[:-1], True] if len(side) else np.zeros(0, bool)
        mark = np.where(last, 1 + is_b[by], 0)  # , within a side, | behind A, ; behind B
        marked = list(map(self.marked.__getitem__, (flat[by] * 3 + mark).tolist()))
        ends = np.cumsum(sizes).tolist()
        return ["".join(marked[i:j]) for i, j in zip([0, *ends], ends)]

    def stretches(self, text: str) -> list[str]:
        return STRETCH.findall(" " + text) if self.cuts else [" " + text]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str | None, path_b: str | None) -> Aligner:
    import public_tokenizers

    key = (path_a or public_tokenizers.path(FILE_A), path_b or public_tokenizers.path(FILE_B))
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


ROWS = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_overlaps", pa.int64()), ("groups_sha256", pa.string()), ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int64()))])
SCHEMA = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, at array<int>, times array<long>, pairs array<long>, held array<long>"


def unique_sums(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and the sum of each one's weights."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.nonzero(np.r_[True, k[1:] != k[:-1]])[0] if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(weights[order], first) if len(k) else weights[:0]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of runs of the given sizes, end to end."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(starts, sizes)


def block_rows(a: Aligner, block: int, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
    """A row per text, with its distinct pairs as places in the block's list and how often it links each; and one row without
    counts that holds the block's pairs and their counts."""
    n = len(texts)
    cut = [a.stretches(t) if t else [] for t in texts]
    per = np.fromiter(map(len, cut), np.int64, n)
    flat = list(chain.from_iterable(cut))
    found = a.align(list(dict.fromkeys(flat)))
    kinds = found.kinds
    number = dict(zip(kinds, range(len(kinds)))) | dict.fromkeys(found.lost, -1)
    kind = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    doc = np.repeat(np.arange(n), per)
    whole = (np.bincount(doc[kind < 0], minlength=n) == 0) & (per > 0)
    held = whole[doc]
    doc, kind = doc[held], kind[held]
    sums = [np.bincount(doc, x[kind], minlength=n).astype(np.int64) for x in (found.n_a, found.n_b, found.n_groups, found.n_links, found.n_overlaps)]
    ends = np.cumsum(per * whole).tolist()
    parts = list(map(found.texts.__getitem__, kind.tolist()))
    digests = [hashlib.sha256("".join(parts[i:j])[:-1].encode()).hexdigest() if j > i else "" for i, j in zip([0, *ends], ends)]
    # links: of each kind of stretch in a text, then of each pair in a text
    pairs, pair = np.unique(found.links, return_inverse=True)
    key, times = unique_sums(doc * max(1, len(kinds)) + kind, np.ones(len(doc), np.int64))
    in_doc, of_kind = key // max(1, len(kinds)), key % max(1, len(kinds))
    many = found.n_links[of_kind]
    at = pair[spread((np.cumsum(found.n_links) - found.n_links)[of_kind], many)]
    width = max(1, len(pairs))
    key, times = unique_sums(np.repeat(in_doc, many) * width + at, np.repeat(times, many))
    offsets = np.searchsorted(key // width, np.arange(n + 1)).astype(np.int32)
    total = np.bincount(key % width, times, minlength=len(pairs)).astype(np.int64)
    used = total > 0  # texts that don't come back link nothing
    place = np.cumsum(used) - 1
    lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (place[key % width].astype(np.int32), times)]
    counts = [pa.array([block] * (n + 1), pa.int64()), pa.concat_arrays([ids, pa.nulls(1, pa.int64())])]
    per_doc = [pa.array(x) for x in sums] + [pa.array(digests, pa.string()), *lists]
    arrays = counts + [pa.concat_arrays([x, pa.nulls(1, x.type)]) for x in per_doc]
    arrays += [pa.array([None] * n + [x], pa.list_(pa.int64())) for x in (pairs[used], total[used])]
    return pa.RecordBatch.from_arrays(arrays, schema=ROWS)


def blocks(texts: list[str]):
    """(from, to) of runs of texts of at most BLOCK_CHARS characters and BLOCK_ROWS rows, at least one text each."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and (size + len(t) > BLOCK_CHARS or i - start == BLOCK_ROWS):
            yield start, i
            start, size = i, 0
        size += len(t)
    if len(texts) > start:
        yield start, len(texts)


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Rows of SCHEMA: documents with their counts and pairs, and a row of pairs for each block. Block numbers hold the partition
    and the run within it."""

    def run(batches):
        a, nth = aligner(path_a, path_b), 0
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for i, j in blocks(texts):
                yield block_rows(a, TaskContext.get().partitionId() << 32 | nth, b.column(0).slice(i, j - i), texts[i:j])
                nth += 1

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)


def pair_counts(rows: DataFrame) -> DataFrame:
    """Rows (pair, n, best) over all blocks: how many links hold the pair, and whether none of its B id's holds more."""
    counts = rows.where("pairs is not null").select(F.inline(F.arrays_zip("pairs", "held"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFF))
    return counts.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy(b)))  # a B id has 50,257 partners at most


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_overlaps), one per input row."""
    rows = stored(aligned(docs, id_col, text_col, path_a, path_b))
    placed = rows.where("pairs is not null").select("block", F.posexplode("pairs").alias("at", "pair"))
    counted = placed.join(stored(pair_counts(rows)), "pair").select(F.col("block").alias("of"), "at", "n", "best")
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256"]
    given = [f for f in ROWS if f.name in kept]
    out = pa.schema([*given, ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def add_up(docs: pa.Table, counts: pa.Table) -> pa.Table:
        size = counts.num_rows
        n, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
        at = counts["at"].to_numpy()
        n[at], best[at] = counts["n"].to_numpy(), counts["best"].to_numpy().astype(np.int64)
        each = docs["at"].combine_chunks()
        owner = np.repeat(np.arange(docs.num_rows), each.value_lengths().to_numpy(zero_copy_only=False))
        places, times = each.flatten().to_numpy(), docs["times"].combine_chunks().flatten().to_numpy()
        sums = []
        for value in (best, n):
            total = np.zeros(docs.num_rows, np.int64)
            np.add.at(total, owner, times * value[places])
            sums.append(pa.array(total))
        return pa.Table.from_arrays([*(docs[f.name] for f in given), *sums], schema=out)

    texts = rows.where("pairs is null").select("block", *kept, "at", "times")
    met = texts.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(add_up, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_overlaps long, groups_sha256 string, n_best long, count_sum long")
    return met.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_overlaps")


def op13_alignment(spark, sf_dir: str) -> DataFrame:
    return alignments(table(spark, sf_dir, "documents"))
