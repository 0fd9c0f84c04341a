"""Scores of a hashed maximum-entropy language model beside those of the unigram model.

Words are counted over all training documents. The most frequent ones fill head classes of SLOTS words each; every other
word belongs to one of TAILS classes by its ending. Classes lie in groups of WAYS, and so do the words of a head class, so
a word is found by two choices among WAYS (its group, its class) and a head word by two more (its group of slots, its slot).
Each choice is a softmax of its own over hashed features of the node that it is made at and the words before: the last word,
the last two, and skips to the second and third last. Words of tail classes follow by the smoothed unigram within the
class, where each class keeps room for one unknown word. As a context, every word counts as itself, by its hash. So every
context's probabilities sum to one.

Weights are trained by distributed gradient updates: each shard runs adaptive gradient steps over its documents in sparse
batches (only the rows that a batch's features hash to are touched), the shards' rows are averaged by the squared gradients that
they took, and the next round starts from the mean. Every training document is used once, in one of ROUNDS rounds.

What goes to the driver and out again is bounded: the HEAD most frequent words with their counts, and the weights. Counts
of rarer words are joined by word. Null texts are empty ones, which hold the end token alone; documents without an id are
training ones; repeated rows count and score as often as they stand there.
"""

from __future__ import annotations

import math
import zlib
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, stored, table

HELD_MOD, HELD = 10, 0
SLOTS, HEADS, TAILS = 64, 32, 32
CLASSES, SOFT, WAYS = HEADS + TAILS, HEADS * SLOTS, 8
HEAD = 131_072  # words whose counts every task holds
FEATURES, ROWS = (4, 4, 3, 3), 1 << 16  # features of each choice, and hashed rows of each feature's table
ROUNDS, RATE, BATCH, SHARD_TOKENS, LEXICON = 2, 0.14, 16384, 4_000_000, 200_000
BLOCK, LEAST_SUM = 256, np.float32(1e-2)
DELTA = 0.1
END = b""


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A to Z lower-cased, one after another, and the number of words of each text. Words end at blanks
    and \\x09 to \\x0D alone."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, at = lists.flatten(), lists.offsets.to_numpy()
    full = pc.greater(pc.binary_length(words), 0)  # blanks at either end give empty words
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), np.diff(before[at - at[0]])


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-4:]) % TAILS


def training(docs: DataFrame) -> DataFrame:
    return docs.where(F.coalesce(crc_mod(F.col("doc_id"), HELD_MOD) != HELD, F.lit(True)))


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (word, k, c) over all documents, k the tail class of the word, counted within runs of texts of a task first."""

    def run(batches):
        for b in batches:
            for _, texts in parts(b.column(0), 16_000_000):
                words, sizes = split(texts)
                counted = words.value_counts()
                yield pa.RecordBatch.from_arrays([counted.field("values"), counted.field("counts")], names=["word", "c"])
                yield pa.RecordBatch.from_arrays([pa.array([END.decode()]), pa.array([len(sizes)], pa.int64())], names=["word", "c"])

    tail = F.crc32(F.substring(F.col("word").cast("binary"), -4, 4)) % TAILS
    counts = docs.select(F.col("text").cast("string")).mapInArrow(run, "word string, c long").where("c > 0").groupBy("word").agg(F.sum("c").alias("c"))
    return counts.select("word", tail.cast("int").alias("k"), "c")


def log_shares(mass: np.ndarray) -> np.ndarray:
    """Logarithms of each row's shares; what has no mass gets next to none."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.log(mass / mass.sum(1, keepdims=True))
    return np.where(np.isfinite(out), out, -1e9).astype(np.float32)


class Vocabulary:
    """The head words in order of frequency, with the sums that the formulas need."""

    def __init__(self, words: list[bytes], counts: list[int], total: int, distinct: int, tails: dict[int, tuple[int, int]]):
        self.words, self.counts, self.total, self.distinct = words, np.array(counts, np.int64), total, distinct
        n, v = np.zeros(TAILS, np.int64), np.zeros(TAILS, np.int64)
        for k, (c, d) in tails.items():
            n[k], v[k] = c, d
        for w, c in zip(words[:SOFT], counts[:SOFT]):
            n[tail_class(w)] -= c
            v[tail_class(w)] -= 1
        self.tail_mass = n + DELTA * (v + 1)
        soft = np.zeros(SOFT)
        soft[: min(SOFT, len(words))] = self.counts[:SOFT] + DELTA
        words_of_class = soft.reshape(HEADS, WAYS, -1)
        classes = np.concatenate([words_of_class.sum((1, 2)), self.tail_mass]).reshape(-1, WAYS)
        self.biases = [log_shares(x) for x in (classes.sum(1)[None, :], classes, words_of_class.sum(2), words_of_class.reshape(-1, SLOTS // WAYS))]
        self.base = math.log10(total + DELTA * (distinct + 1)) if total else math.log10(DELTA)


def vocabulary(counts: DataFrame) -> Vocabulary:
    # only words as frequent as the HEAD-th, to within a sixteenth of a doubling, are put in order
    size = F.floor(F.log2("c") * 16)
    sizes, least, held = counts.groupBy(size.alias("s")).count().orderBy(F.desc("s")).collect(), 0, 0
    for r in sizes:
        least, held = r["s"], held + r["count"]
        if held >= HEAD:
            break
    top = counts.where(size >= least).orderBy(F.desc("c"), "word").limit(HEAD).toArrow()
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    tails = {r[0]: (r[1], r[2]) for r in counts.groupBy("k").agg(F.sum("c"), F.count("*")).collect()}
    return Vocabulary(top["word"].cast(pa.binary()).to_pylist(), top["c"].to_pylist(), total, distinct, tails)


class Lexicon(dict):
    """Word to row: hash as a context, class, slot (-1 in tail classes) and count (-1 for words that the head does not hold)."""

    def __init__(self, vocab: Vocabulary):
        super().__init__()
        self.vocab, self.rank = vocab, {w: i for i, w in enumerate(vocab.words)}
        self.forget()

    def forget(self):
        self.clear()
        self.new, self.names, self.cols = [], [], np.zeros((0, 4), np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def look(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all tokens, an end after each text, and the number of tokens of each text. Only distinct words are looked up."""
        if len(self) > LEXICON:
            self.forget()
        words, sizes = split(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        ids = np.full(len(words) + len(sizes), self[END])
        inner = np.ones(len(ids), bool)
        inner[np.cumsum(sizes + 1) - 1] = False
        ids[inner] = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))[coded.indices.to_numpy()]
        if self.new:
            n, crc = len(self.new), zlib.crc32
            rank = np.fromiter(map(self.rank.get, self.new, repeat(-1)), np.int64, n)
            tail = HEADS + np.fromiter([crc(w[-4:]) for w in self.new], np.int64, n) % TAILS
            soft = (rank >= 0) & (rank < SOFT)
            rows = [np.fromiter(map(crc, self.new), np.int64, n), np.where(soft, rank // SLOTS, tail), np.where(soft, rank % SLOTS, -1), np.where(rank >= 0, self.vocab.counts[rank] if len(self.rank) else -1, -1)]
            self.cols = np.concatenate([self.cols, np.stack(rows, 1)])
            self.names += self.new
            self.new = []
        return ids, sizes + 1


def contexts(hashes: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Hashes of the words one, two and three before each token, 0 before a document's start."""
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = []
    for k in (1, 2, 3):
        w = np.zeros(len(hashes), np.int64)
        w[k:] = hashes[:-k] if len(hashes) > k else hashes[:0]
        out.append(np.where(place >= k, w, 0))
    return out


def mixed(*columns: np.ndarray) -> np.ndarray:
    """64 bits that integer columns hash to together."""
    h = np.uint64(0x9E3779B9)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def contexts_of(before) -> list[np.ndarray]:
    """What the features look at, hashed: the last word, the last two, and skips to the second and third last."""
    a, b, c = before
    return [mixed(a), mixed(a, b), mixed(b), mixed(c)]


def features(level: int, near: list[np.ndarray], nodes: np.ndarray) -> list[np.ndarray]:
    """Rows of the features' tables that the contexts hash to at the node."""
    place = (nodes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return [(((h ^ place) * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(48)).astype(np.uint16) for h in near[: FEATURES[level]]]


def choices(classes: np.ndarray, slots: np.ndarray):
    """(level, tokens that choose at it, their nodes, what they choose) for tokens of these classes and slots (-1: none)."""
    every, head = np.arange(len(classes)), np.nonzero(slots >= 0)[0]
    c, s = classes[head], slots[head]
    yield 0, every, np.zeros_like(classes), classes // WAYS
    yield 1, every, classes // WAYS, classes % WAYS
    if len(head):
        yield 2, head, c, s // WAYS
        yield 3, head, c * WAYS + s // WAYS, s % WAYS


def logits(tables: np.ndarray, feats: list[np.ndarray], bias: np.ndarray) -> np.ndarray:
    z = bias.copy()
    for w, f in zip(tables, feats):
        z += np.take(w, f, axis=0)
    return z


ONES, ROW = np.ones(WAYS, np.float32), np.dtype((np.void, 4 * WAYS))


def log_probability(tables: np.ndarray, feats: list[np.ndarray], bias: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Natural logarithms; the biases are log-probabilities, so the sums stay far from overflow."""
    z = logits(tables, feats, bias)
    mine = z[np.arange(len(z)), target]
    return mine - np.log(np.exp(z, out=z) @ ONES)


class Learner:
    """One shard's copy of a choice's tables with row-wise adaptive steps."""

    def __init__(self, start: np.ndarray):
        self.w, self.sums = start.copy(), np.full(start.shape[:2], LEAST_SUM, np.float32)

    def step(self, feats: list[np.ndarray], bias: np.ndarray, target: np.ndarray) -> None:
        g = logits(self.w, feats, bias)
        np.exp(g, out=g)
        g /= (g @ ONES)[:, None]
        g[np.arange(len(g)), target] -= 1
        slopes = g.T.astype(np.float64, order="C")
        for w, sums, f in zip(self.w, self.sums, feats):
            order = np.argsort(f, kind="stable")
            rows = f[order]
            first = np.empty(len(rows), bool)
            first[0], first[1:] = True, rows[1:] != rows[:-1]
            place = np.empty(len(rows), np.int64)
            place[order] = np.cumsum(first) - 1
            starts = np.nonzero(first)[0]
            rows, n = rows[starts], len(starts)
            add = np.empty((n, WAYS), np.float32)
            for i, s in enumerate(slopes):
                add[:, i] = np.bincount(place, s, n)
            seen = np.take(sums, rows)
            seen += (add * add) @ ONES / WAYS
            sums[rows] = seen
            add *= (-RATE / np.sqrt(seen))[:, None]
            add += np.take(w, rows, axis=0)
            w.view(ROW)[rows, 0] = add.view(ROW)[:, 0]  # a row moves as one item, which is several times faster


def parts(texts: pa.Array, size: int = 3_000_000):
    """(first row, texts) of runs of whole texts of about so many bytes; what a run took goes back before the next."""
    run = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)) // size
    starts = [0, *(np.nonzero(run[1:] != run[:-1])[0] + 1).tolist(), len(run)]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield a, texts.slice(a, b - a)
            pa.default_memory_pool().release_unused()


def train_round(docs: DataFrame, vocab, weights, shards: int) -> tuple[np.ndarray, ...]:
    """The mean of the shards' tables after one pass over docs. Blocks of rows are summed by the tasks that own them."""

    def shard(batches):
        lex, learners = Lexicon(vocab.value), [Learner(w) for w in weights.value]
        biases = lex.vocab.biases
        for b in batches:
            for _, texts in parts(b.column(0)):
                ids, sizes = lex.look(texts)
                hashes, classes, slots, _ = lex.cols[ids].T
                before = contexts_of(contexts(hashes, sizes))
                for a in range(0, len(ids), BATCH):
                    near = [x[a : a + BATCH] for x in before]
                    for level, who, nodes, target in choices(classes[a : a + BATCH], slots[a : a + BATCH]):
                        mine = near if len(who) == len(near[0]) else [x[who] for x in near]
                        learners[level].step(features(level, mine, nodes), biases[level][nodes], target)
        part, out = TaskContext.get().partitionId() % halves, []
        for t, learner in enumerate(learners):
            used, w = learner.sums.ravel() - LEAST_SUM, learner.w.reshape(-1, WAYS)
            out += [(t * 1_000_000 + at, used[at : at + BLOCK], w[at : at + BLOCK]) for at in range(0, len(used), BLOCK)]
        yield sent(part, out)

    def reduce(batches):
        sums: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for key, rows, used, w in zip(*(c.to_pylist() for c in b.columns[1:])):
                s = sums.setdefault(key, [np.zeros(BLOCK), np.zeros((BLOCK, WAYS))])
                rows, used = np.frombuffer(rows, np.uint8), np.frombuffer(used, np.float32)
                s[0][rows] += used
                s[1][rows] += used[:, None] * np.frombuffer(w, np.float16).reshape(-1, WAYS)
        yield sent(0, [(k, used, w / np.maximum(used, 1e-30)[:, None]) for k, (used, w) in sums.items()])

    def sent(part: int, blocks: list) -> pa.RecordBatch:
        """The used rows of blocks (key, used, weights)."""
        kept = [(key, rows, used[rows], w[rows]) for key, used, w in blocks if len(rows := np.nonzero(used > 0)[0])]
        cols = [[k[0] for k in kept], [k[1].astype(np.uint8).tobytes() for k in kept], [k[2].astype(np.float32).tobytes() for k in kept], [k[3].astype(np.float16).tobytes() for k in kept]]
        return pa.RecordBatch.from_arrays([pa.array([part] * len(kept), pa.int64()), pa.array(cols[0], pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["part", "block", "rows", "used", "w"])

    schema = "part long, block long, rows binary, used binary, w binary"
    halves = max(1, math.isqrt(shards))  # a block's rows are summed by about the square root of the shards first
    fresh = [w.copy() for w in weights.value]
    some = docs.mapInArrow(shard, schema).repartition("block", "part").mapInArrow(reduce, schema)
    for r in some.repartition("block").mapInArrow(reduce, schema).collect():
        t, at = divmod(r["block"], 1_000_000)
        rows = np.frombuffer(r["rows"], np.uint8).astype(np.int64) + at
        fresh[t].reshape(-1, WAYS)[rows] = np.frombuffer(r["w"], np.float16).reshape(-1, WAYS)
    return tuple(fresh)


def train(docs: DataFrame, vocab: Vocabulary) -> tuple[np.ndarray, ...]:
    """Weights of every level from the training documents."""
    sc = docs.sparkSession.sparkContext
    sent = sc.broadcast(vocab)
    weights = tuple(np.zeros((k, ROWS, WAYS), np.float32) for k in FEATURES)
    shards = max(1, math.ceil(vocab.total / SHARD_TOKENS / ROUNDS))
    for r in range(ROUNDS):
        mine = docs.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(ROUNDS)) == r).select(F.col("text").cast("string")).coalesce(shards)
        now = sc.broadcast(weights)
        weights = train_round(mine, sent, now, shards)
        now.unpersist()
    return weights


ROW_SCHEMA = "row long, doc_id long, n_tokens long, n_known long, base double, score double, rest array<struct<word:string,k:int,n:int>>"
REST = pa.list_(pa.struct([("word", pa.string()), ("k", pa.int32()), ("n", pa.int32())]))


def scored_rows(docs: DataFrame, vocab, weights) -> DataFrame:
    """One row per document with the sums over words of known counts, and the rest of its words with their classes."""

    def run(batches):
        lex = Lexicon(vocab.value)
        v = lex.vocab
        row = TaskContext.get().partitionId() << 36
        for b in batches:
            for at, texts in parts(b.column(1)):
                ids, sizes = lex.look(texts)
                cols = lex.cols[ids]
                hashes, classes, slots, counts = cols.T
                before = contexts_of(contexts(hashes, sizes))
                log_p = np.zeros(len(ids))
                for a in range(0, len(ids), BATCH):
                    near, out = [x[a : a + BATCH] for x in before], log_p[a : a + BATCH]
                    for level, who, nodes, target in choices(classes[a : a + BATCH], slots[a : a + BATCH]):
                        mine = near if len(who) == len(out) else [x[who] for x in near]
                        out[who] += log_probability(weights.value[level], features(level, mine, nodes), v.biases[level][nodes], target)
                log_p /= math.log(10)
                known, tail = counts >= 0, slots < 0
                local = np.where(known, np.log10(np.maximum(counts, 0) + DELTA), 0.0)
                log_p += np.where(tail & known, local - np.log10(v.tail_mass)[np.maximum(classes - HEADS, 0)], 0.0)
                base = np.where(known, local - v.base, 0.0)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                odd = np.nonzero(~known)[0]
                pairs, times = np.unique((np.repeat(np.arange(len(sizes)), sizes)[odd] << 32) + ids[odd], return_counts=True)
                owner, word = pairs >> 32, pairs & 0xFFFFFFFF
                names = pa.array([lex.names[i] for i in word.tolist()], pa.binary()).cast(pa.string())
                items = pa.StructArray.from_arrays([names, pa.array(lex.cols[word, 1] - HEADS, pa.int32()), pa.array(times, pa.int32())], fields=list(REST.value_type))
                rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(sizes) + 1)), pa.int32()), items)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + len(texts))), b.column(0).slice(at, len(texts)), pa.array(sizes), pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(log_p, starts)), rest],
                    names=["row", "doc_id", "n_tokens", "n_known", "base", "score", "rest"],
                )
                row += len(texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ROW_SCHEMA)


def score(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one per input row."""
    sc, known = docs.sparkSession.sparkContext, training(docs)
    counts = stored(word_counts(known))
    vocab = vocabulary(counts)
    weights = sc.broadcast(train(known, vocab))
    rows = stored(scored_rows(docs, sc.broadcast(vocab), weights))
    # words that the head does not hold: their counts by a join, their share of each sum by row
    last_word, last_count = (vocab.words[-1].decode(), int(vocab.counts[-1])) if vocab.words else ("", 0)
    rarer = counts.drop("k").where((F.col("c") < last_count) | ((F.col("c") == last_count) & (F.col("word") > last_word)))
    masses = F.array(*[F.lit(float(m)) for m in vocab.tail_mass])
    c = F.coalesce("c", F.lit(0))
    rest = rows.select("row", F.inline("rest")).join(rarer, "word", "left")
    sums = rest.groupBy("row").agg(
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * (F.log10(c + DELTA) - vocab.base)).alias("more_base"),
        F.sum(F.col("n") * (F.log10(c + DELTA) - F.log10(F.element_at(masses, F.col("k") + 1)))).alias("more_score"),
    )
    held = F.coalesce(crc_mod(F.col("doc_id"), HELD_MOD) == HELD, F.lit(False))
    return rows.drop("rest").join(sums, "row", "left").select(
        "doc_id",
        held.alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(vocab.total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )


def op6_language_model(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
