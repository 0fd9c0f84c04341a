"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels mark whole documents, so tokens are labelled first: words and stems are picked greedily, each the one that explains
most toxic documents not yet explained, less the clean ones that hold it; tokens with them in toxic documents are toxic. The
chain has two tags; a token's potential comes from hashed features of its word and its neighbours. Forward and backward
messages give each token's marginal. A document's score is the chance that one token at least is toxic if each is so by its
marginal, calibrated on the training documents; tokens whose marginal is a half at least are its offending spans.

The fit takes at most FIT_DOCS labelled documents of each label, those with the smallest hashed ids, each once and up to its
end (the shortest row where an id repeats; of repeated labels the highest). Each label has half of FIT_CHARS and what the
other leaves; documents that would pass that are skipped, but the shortest of a label is always taken. So bounded, it runs
on the driver. Scoring covers all rows, repeated ones too, and whole texts. Null and empty texts have no tokens and score
the calibrated floor. Rows and labels without an id are not learned from. Without both labels every score is the share of
toxic labels, 0 if there are none.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, table

HELD_MOD, HELD = 5, 0
FIT_DOCS, FIT_CHARS, SEEDS, WINDOW, STEPS = 2000, 12_000_000, 200, 48, 80
SLOTS = 1 << 18  # of each hashed table
LEXICON = 300_000  # words whose weights a worker remembers
LONGEST = 24
STEMS = (3, 4, 5, 6, 7)
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The words as they stand in the text, each lower-cased by itself, so that the n-th is the n-th match of WORD."""
    found = WORD.findall(text or "")
    return " ".join(found).lower().split(" ") if found else []


def slots(word: str) -> tuple[int, ...]:
    """Hashed features of a word: itself, its stems of three to seven letters, its ending with its length."""
    crc = zlib.crc32
    stems = [crc(b"^" + word[:k].encode("utf-8", "replace")) % SLOTS for k in STEMS]
    return crc(word.encode("utf-8", "replace")) % SLOTS, *stems, crc(b"%d$" % min(len(word), 12) + word[-3:].encode("utf-8", "replace")) % SLOTS


def marks(word: str) -> list[str]:
    """What may mark a word as toxic: the word itself or a proper stem of it."""
    return ["=" + word] + [word[:k] for k in STEMS if len(word) > k]


def seed_marks(docs: list[list[str]], toxic: np.ndarray) -> set[str]:
    """Words and stems that explain the toxic documents: each the one of the highest share of toxic documents
    not yet explained by others less twice the share of clean ones that hold it, the longest of equals."""
    vocab: dict[str, int] = {}
    known: dict[str, list[int]] = {}  # marks by word, as numbers: a word's marks are spelled out once

    def held(words: list[str]) -> np.ndarray:
        out: set[int] = set()
        for w in set(words):
            if w not in known:
                known[w] = [vocab.setdefault(m, len(vocab)) for m in marks(w)]
            out.update(known[w])
        return np.fromiter(out, np.int32, len(out))

    left = [held(d) for d, t in zip(docs, toxic) if t]
    size = len(vocab)  # marks of toxic documents; those of clean ones alone come after and cannot be seeds
    clean = np.zeros(size)
    for d, t in zip(docs, toxic):
        if not t:
            x = held(d)
            clean[x[x < size]] += 1
    names = list(vocab)[:size]
    whole = max(1, len(left))
    longer, cost = np.array([len(m) for m in names]) * 1e-6, 2 * clean / max(1, len(docs) - len(left))
    least = max(3 / whole, 0.004)
    seeds: set[str] = set()
    while left and len(seeds) < SEEDS:
        gain = np.bincount(np.concatenate(left), minlength=size) / whole - cost
        best = int(np.argmax(gain + longer))
        if gain[best] < least:
            break
        seeds.add(names[best])
        left = [x for x in left if best not in x]
    return seeds


def forward(e: np.ndarray, mask: np.ndarray, a: float, b: float, c: float):
    """For windows in rows: log of the sum over all paths, relative to the all-clean path, and the scaled messages."""
    A, B, C = np.exp([a, b, c])
    n, t = e.shape
    x = np.exp(np.clip(e, -40, 40))
    ratio, total = np.zeros((n, t)), np.zeros(n)
    r = np.zeros(n)
    for i in range(t):
        s = 1 + r * B
        now = (A + r * C) * x[:, i] / s
        total += np.where(mask[:, i], np.log(s), 0)
        r = np.where(mask[:, i], now, r)
        ratio[:, i] = r
    return total + np.log1p(r), ratio


def marginals(e: np.ndarray, mask: np.ndarray, a: float, b: float, c: float):
    """Probability of the toxic tag for each place, and the expected transitions clean-toxic, toxic-clean, toxic-toxic."""
    A, B, C = np.exp([a, b, c])
    n, t = e.shape
    x = np.exp(np.clip(e, -40, 40))
    _, ratio = forward(e, mask, a, b, c)
    p, q = np.zeros((n, t)), np.ones(n)  # q: backward message of toxic over that of clean
    trans = np.zeros(3)
    for i in range(t - 1, -1, -1):
        m = mask[:, i]
        top = ratio[:, i] * q
        p[:, i] = np.where(m, top / (1 + top), 0)
        before = ratio[:, i - 1] if i else np.zeros(n)
        xq = x[:, i] * q
        stay, enter, leave, both = 1.0, A * xq, before * B, before * C * xq
        z = stay + enter + leave + both
        trans += [np.sum(np.where(m, v / z, 0)) for v in (enter, leave, both)]
        q = np.where(m, (B + C * xq) / (1 + A * xq), q)
    return p, trans


class Chain:
    """Parameters: three hashed tables (the word, the word before, the word after), a bias and three transitions."""

    def __init__(self):
        self.here, self.left, self.right = (np.zeros(SLOTS, np.float32) for _ in range(3))
        self.bias, self.trans, self.scale, self.shift = -6.0, np.array([0.0, 0.0, 0.5]), 1.0, 0.0

    def potentials(self, feats: np.ndarray) -> np.ndarray:
        """Columns: the word's own potential with the bias, what it gives the next word, what it gives the one before."""
        return np.stack([self.here[feats].sum(1) + self.bias, self.left[feats[:, 0]], self.right[feats[:, 0]]], 1)

    def calibrated(self, log_clean: np.ndarray) -> np.ndarray:
        """Score from the logarithm of the chance that no token is toxic."""
        toxic = np.log(np.maximum(-np.expm1(np.minimum(log_clean, -1e-12)), 1e-300))
        return 1 / (1 + np.exp(-np.clip(self.scale * (toxic - np.maximum(log_clean, -300)) + self.shift, -30, 30)))


def windows(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token ids cut into rows of WINDOW, with the row's document; missing places are -1."""
    rows, owner = [], []
    for d, x in enumerate(ids):
        for i in range(0, len(x), WINDOW):
            rows.append(np.pad(x[i : i + WINDOW], (0, max(0, WINDOW - len(x) + i)), constant_values=-1))
            owner.append(d)
    grid = np.array(rows, np.int64).reshape(-1, WINDOW)
    return grid, grid >= 0, np.array(owner)


def fit(texts: list[str | None], toxic: np.ndarray) -> Chain:
    """A chain from documents and their labels, by full-batch adaptive gradient steps."""
    docs = [words_of(t) for t in texts]
    seeds = seed_marks(docs, toxic)
    vocab: dict[str, int] = {}
    ids = [np.fromiter((vocab.setdefault(w, len(vocab)) for w in d), np.int64, len(d)) for d in docs]
    chain = Chain()
    if not vocab:
        return chain
    grid, mask, owner = windows(ids)
    seeded = np.zeros(len(vocab) + 1, bool)
    seeded[:-1] = [not seeds.isdisjoint(marks(w)) for w in vocab]
    tags = seeded[grid] & mask & toxic.astype(bool)[owner][:, None]
    feats = np.array([slots(w) for w in vocab] + [(0,) * (len(STEMS) + 2)])
    flat = np.where(mask, grid, len(vocab))
    before, after = np.roll(flat, 1, 1), np.roll(flat, -1, 1)
    before[:, 0], after[:, -1] = len(vocab), len(vocab)
    size = len(vocab) + 1
    sums = {k: 1e-3 * np.ones(SLOTS, np.float32) for k in ("here", "left", "right")}
    sums |= {"bias": 1e-3, "trans": 1e-3 * np.ones(3)}
    observed = np.array([(tags[:, 1:] & ~tags[:, :-1]).sum() + tags[:, 0].sum(), (~tags[:, 1:] & tags[:, :-1] & mask[:, 1:]).sum(), (tags[:, 1:] & tags[:, :-1]).sum()], float)
    for step in range(STEPS):
        pot = chain.potentials(feats)
        pot[-1] = 0
        e = pot[flat, 0] + pot[before, 1] + pot[after, 2]
        p, expected = marginals(e, mask, *chain.trans)
        err = np.where(mask, p - tags, 0)
        by = [np.bincount(i.ravel(), err.ravel(), size)[:-1] for i in (flat, before, after)]
        grads = {
            "here": np.bincount(feats[:-1].ravel(), np.repeat(by[0], feats.shape[1]), SLOTS) + 0.02 * chain.here,
            "left": np.bincount(feats[:-1, 0], by[1], SLOTS) + 0.5 * chain.left,
            "right": np.bincount(feats[:-1, 0], by[2], SLOTS) + 0.5 * chain.right,
            "bias": err.sum(),
            "trans": (expected - observed) + 0.1 * chain.trans,
        }
        for k, g in grads.items():
            sums[k] = sums[k] + g * g
            setattr(chain, k, (getattr(chain, k) - 1.0 * g / np.sqrt(sums[k])).astype(np.float32) if k in ("here", "left", "right") else getattr(chain, k) - (0.3 if k == "bias" else 0.1) * g / np.sqrt(sums[k]))
    # calibration of document scores: one scale and shift by a few Newton steps of logistic regression
    pot = chain.potentials(feats)
    log_clean = all_clean(marginals_of([pot[x] for x in ids], chain))
    z = np.clip(np.log(np.maximum(-np.expm1(np.minimum(log_clean, -1e-12)), 1e-300)) - np.maximum(log_clean, -300), -30, 30)
    x, y, beta = np.stack([z, np.ones_like(z)], 1), toxic.astype(float), np.array([1.0, 0.0])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(2)
        beta -= np.clip(np.linalg.solve(h, x.T @ (p - y) + 0.5 * (beta - [1.0, 0.0])), -0.5, 0.5)
    if beta[0] > 0.05:
        chain.scale, chain.shift = float(beta[0]), float(beta[1])
    return chain


def marginals_of(pots: list[np.ndarray], chain: Chain) -> list[np.ndarray]:
    """Marginals of each document's tokens. Documents stand side by side from the longest on, so each place is one step for
    all that reach it; the LONGEST longest go by themselves, or long texts would be walked with few beside them."""
    A, B, C = np.exp(chain.trans)
    order = sorted(range(len(pots)), key=lambda i: -len(pots[i]))
    out: list[np.ndarray] = [np.zeros(0)] * len(pots)
    for i in order[:LONGEST]:
        out[i] = np.array(places(pots[i], chain)) if len(pots[i]) else out[i]
    order = [i for i in order[LONGEST:] if len(pots[i])]
    if not order:
        return out
    lengths = np.array([len(pots[i]) for i in order])
    starts = np.cumsum(lengths) - lengths
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # documents longer than each place
    ends = np.cumsum(alive)
    at = ends - alive
    doc = np.arange(ends[-1]) - np.repeat(at, alive)
    by_place = starts[doc] + np.repeat(np.arange(lengths[0]), alive)
    x = np.concatenate([weights(pots[i]) for i in order])[by_place]
    ratio, p = np.empty_like(x), np.empty_like(x)
    r, q = np.zeros(len(order)), np.ones(len(order))
    for a, b in zip(at.tolist(), ends.tolist()):
        k = b - a
        r = ratio[a:b] = (A + r[:k] * C) * x[a:b] / (1 + r[:k] * B)
    for a, b in zip(reversed(at.tolist()), reversed(ends.tolist())):
        k = b - a
        top = ratio[a:b] * q[:k]
        p[a:b] = top / (1 + top)
        xq = x[a:b] * q[:k]
        q[:k] = (B + C * xq) / (1 + A * xq)
    flat = np.empty_like(p)
    flat[by_place] = p
    for i, part in zip(order, np.split(flat, starts[1:])):
        out[i] = part
    return out


def weights(pot: np.ndarray) -> np.ndarray:
    """What each token's toxic tag weighs by itself, its neighbours' words counted in."""
    e = pot[:, 0].astype(np.float64)
    e[1:] += pot[:-1, 1]
    e[:-1] += pot[1:, 2]
    return np.exp(np.clip(e, -40, 40))


def all_clean(found: list[np.ndarray]) -> np.ndarray:
    """Logarithm of the chance that no token of a document is toxic, each being so by its marginal."""
    return np.array([np.log1p(-np.minimum(p, 1 - 1e-12)).sum() for p in found])


class Lexicon(dict):
    """Word to row of remembered potentials; a new word gets the next row."""

    def __init__(self, chain: Chain):
        super().__init__()
        self.chain, self.new, self.rows = chain, [], np.zeros((0, 3), np.float32)

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def look(self, docs: list[list[str]]) -> list[np.ndarray]:
        if len(self) > LEXICON:
            self.clear()
            self.rows = np.zeros((0, 3), np.float32)
        ids = [np.fromiter(map(self.__getitem__, d), np.int64, len(d)) for d in docs]
        if self.new:
            self.rows = np.concatenate([self.rows, self.chain.potentials(np.array([slots(w) for w in self.new])).astype(np.float32)])
            self.new = []
        return [self.rows[i] for i in ids]


def places(pot: np.ndarray, chain: Chain) -> list[float]:
    """Marginals of one document's tokens, by two passes over plain numbers."""
    A, B, C = np.exp(chain.trans).tolist()
    xs = weights(pot).tolist()
    ratios, r = [], 0.0
    for x in xs:
        r = (A + r * C) * x / (1 + r * B)
        ratios.append(r)
    q, out = 1.0, []
    for x, r in zip(reversed(xs), reversed(ratios)):
        top = r * q
        out.append(top / (1 + top))
        xq = x * q
        q = (B + C * xq) / (1 + A * xq)
    return out[::-1]


def spans(text: str, p: np.ndarray, least: float = 0.5) -> list[dict]:
    """Runs of tokens whose marginal is at least `least`, by their places in the text."""
    out, last = [], -2
    marked = {i: float(p[i]) for i in np.nonzero(p >= least)[0].tolist()}
    for i, m in enumerate(WORD.finditer(text)) if marked else ():
        if i in marked:
            if i == last + 1:
                out[-1]["end"], out[-1]["p"] = m.end(), max(out[-1]["p"], marked[i])
            else:
                out.append({"start": m.start(), "end": m.end(), "p": marked[i]})
            last = i
    return out


def within(rows: list, chars: int | None = None) -> list:
    """The rows (y, key.size) that fit into so many characters, in order, those too long skipped. Each label has half of
    them and what the other leaves; its shortest row is always taken."""
    chars = FIT_CHARS if chars is None else chars
    whole = {y: sum(r["key"]["size"] for r in rows if r["y"] == y) for y in (0, 1)}
    left = {y: max(chars // 2, chars - whole[1 - y]) for y in (0, 1)}
    least = {y: min((i for i, r in enumerate(rows) if r["y"] == y), key=lambda i: rows[i]["key"]["size"], default=None) for y in (0, 1)}
    for y, i in least.items():
        left[y] -= rows[i]["key"]["size"] if i is not None else 0
    out = []
    for i, r in enumerate(rows):
        y, size = r["y"], r["key"]["size"]
        if i == least[y]:
            out.append(r)
        elif size <= left[y]:
            left[y] -= size
            out.append(r)
    return out


def learn(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Chain | float:
    """A chain from docs and labels (doc_id, toxic) outside the held-out part, or the share of toxic labels if it is 0 or 1."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), HELD_MOD) != HELD)).groupBy(F.col("doc_id").alias("l_id")).agg(F.max("toxic").alias("y"))
    ranked = [known.where(F.col("y") == y).orderBy(F.xxhash64("l_id"), "l_id").limit(fit_docs) for y in (0, 1)]
    chosen = ranked[0].unionByName(ranked[1])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.col("doc_id").alias("d_id"), text.alias("text"), F.struct(F.length(text).alias("size"), F.xxhash64(text).alias("hash")).alias("key"))
    sizes = texts.join(F.broadcast(chosen), F.col("d_id") == F.col("l_id")).groupBy("l_id", "y").agg(F.min("key").alias("key")).orderBy(F.xxhash64("l_id"), "l_id")
    picked = docs.sparkSession.createDataFrame(within(sizes.collect()), sizes.schema)
    mine = texts.join(F.broadcast(picked.withColumnRenamed("key", "l_key")), (F.col("d_id") == F.col("l_id")) & (F.col("key") == F.col("l_key")))
    rows = mine.groupBy("l_id", "y").agg(F.min("text").alias("text")).orderBy(F.xxhash64("l_id"), "l_id").toArrow()
    texts, y = rows["text"].to_pylist(), np.array(rows["y"].to_pylist())
    if not len(y) or y.min() == y.max():
        return float(y.mean()) if len(y) else 0.0
    return fit(texts, y)


def tag(docs: DataFrame, chain: Chain | float, with_spans: bool = True) -> DataFrame:
    """Rows (doc_id, score, spans), one per input row; spans (start, end, p) count characters of the text."""
    place = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
    state: dict[str, Lexicon] = {}

    def run(batches):
        lex = None if isinstance(chain, float) else state.setdefault("lexicon", Lexicon(chain))
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                texts = [t or "" for t in part.column(1).to_pylist()]
                if lex is None:
                    score, found = np.full(len(texts), chain), [[] for _ in texts]
                else:
                    marginal = marginals_of(lex.look([words_of(t) for t in texts]), chain)
                    score = chain.calibrated(all_clean(marginal))
                    found = [spans(t, p) if with_spans else [] for t, p in zip(texts, marginal)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score), pa.array(found, place)], names=["doc_id", "score", "spans"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, spans array<struct<start:int,end:int,p:double>>")


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = tag(docs, learn(docs, table(spark, sf_dir, "labels")))
    held = F.coalesce(crc_mod(F.col("doc_id"), HELD_MOD) == HELD, F.lit(False))
    offsets = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"])), " ").alias("offsets")
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"), offsets)
