"""BPE encoding and decoding with a public vocabulary file.

Words are merged in batches over a segment tree: leaf i of a word holds the rank of the pair (symbol i, next symbol) and
its place, so the root is the leftmost pair of the lowest rank. Each merge rewrites one symbol and at most three leaves and
repairs their paths to the root, until no mergeable pair remains. The trees of all new words of a batch are rows of one
array, so each step works on all of them at once; where few words share a length, such as very long ones, each has a tree of
plain numbers, the same tree in the same order. A bounded two-generation cache keeps the ids of words seen before.

Normalisation and splitting follow the vocabulary's file: canonical composition, white space to single blanks, lower case;
contractions, letter runs, single digits and mark runs are words; special tokens are cut out first.

Null and empty texts give no ids; repeated rows give equal ids; a null id stays; an empty table gives an empty one; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

VOCABULARY = "word_bpe_49k.json"
CACHE_WORDS, FEW = 150_000, 12
LONG = np.iinfo(np.int64).max
PLACE = 1 << 32


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: visible Latin-1 as it is, the rest from U+0100 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(spare)) for b in range(256)]


class PairTable:
    """Open-addressed table from symbol pairs to merge ranks, looked up for whole arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        n = 1 << int(np.ceil(np.log2(max(16, 4 * len(left)))))
        self.mask, self.keys, self.ranks = n - 1, np.full(n, -1, np.int64), np.full(n, LONG >> 33, np.int64)
        self.longest = 1
        for rank, key in enumerate((left.astype(np.int64) << 20 | right).tolist()):
            at, steps = self._home(key), 1
            while self.keys[at] not in (-1, key):
                at, steps = (at + 1) & self.mask, steps + 1
            if self.keys[at] == -1:  # the first of repeated merges holds
                self.keys[at], self.ranks[at] = key, rank
            self.longest = max(self.longest, steps)

    def _home(self, key):
        return ((key * 0x9E3779B1) >> 13) & self.mask

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or a rank beyond all where the pair doesn't merge."""
        key = left << 20 | right
        at = self._home(key)
        out = np.where(self.keys[at] == key, self.ranks[at], LONG >> 33)
        open_ = np.nonzero((self.keys[at] != key) & (self.keys[at] != -1))[0]
        for _ in range(self.longest):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            k = self.keys[at[open_]]
            hit = k == key[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (k != -1)]
        return out


NO_PAIR = LONG >> 33


class Codec:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max(*vocab.values(), *self.specials.values()) + 1
        self.tokens = [""] * size
        for token, i in chain(vocab.items(), self.specials.items()):
            self.tokens[i] = token
        self.numbers = list(map(str, range(size)))
        letters = byte_letters()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.last = np.array([vocab.get(c + self.suffix, -1) for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = PairTable(np.array([vocab[a] for a, _ in merges]), np.array([vocab[b] for _, b in merges]))
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.ranks: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            self.ranks.setdefault(vocab[a] << 20 | vocab[b], rank)
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.controls = re.compile("[\x1c-\x1f]").search  # blanks to str.split(), marks to the vocabulary
        self.cut = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}
        self.ints = list(range(size))

    # text to words

    def normal(self, text: str) -> str:
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()  # a final sigma is no exception here

    def chunks(self, text: str) -> list[str]:
        """Runs of a text without special tokens that no word crosses: what stands between blanks."""
        return regex.split(r"\s+", text) if self.controls(text) else text.split()

    # words to ids

    def merge(self, words: list[str]) -> list[tuple[int, ...]]:
        """Ids of each word, by segment trees over words of about one length at a time."""
        raw = [w.encode("utf-8", "replace") for w in words]
        out: list[tuple[int, ...]] = [()] * len(words)
        groups: dict[int, list[int]] = {}
        for i, r in enumerate(raw):
            groups.setdefault(max(1, (len(r) - 1).bit_length()), []).append(i)
        for level, members in groups.items():
            if len(members) < FEW:
                for i in members:
                    out[i] = self._merge_one(raw[i], 1 << level)
                continue
            step = max(1, (1 << 20) >> level)
            for a in range(0, len(members), step):
                part = members[a : a + step]
                for i, ids in zip(part, self._merge([raw[i] for i in part], 1 << level)):
                    out[i] = ids
        return out

    def _merge(self, raw: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Rows of trees and of linked symbols lie flat; column `width` of the symbols is the end of every word."""
        n, lengths, wide = len(raw), np.fromiter(map(len, raw), np.int64, len(raw)), width + 1
        data = np.frombuffer(b"".join([r.ljust(width, b"\0") for r in raw]), np.uint8).reshape(n, width)
        cols, last = np.arange(width), (lengths - 1)[:, None]
        sym = np.full((n, wide), -1, np.int64)
        sym[:, :width] = np.where(cols < last, self.inner[data], np.where(cols == last, self.last[data], -1))
        tree = np.full((n, 2 * width), LONG, np.int64)
        tree[:, width : 2 * width - 1] = self._key(sym[:, : width - 1].ravel(), sym[:, 1:width].ravel(), np.tile(cols[: width - 1], n), True).reshape(n, width - 1)
        for i in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1], out=tree[:, i])
        steps = np.arange(1, wide + 1)
        nxt = np.where(steps < lengths[:, None], steps, width).ravel()
        prv = np.tile(np.concatenate([[width], np.arange(width)]), n)
        sym, tree = sym.ravel(), tree.ravel()
        rows = np.nonzero(tree[1 :: 2 * width] < LONG)[0]
        while len(rows):
            base, trees = rows * wide, rows * (2 * width)
            root = tree[trees + 1]
            at, new = root % PLACE, self.merged[root // PLACE]
            here = base + at
            gone = nxt[here]
            after, before = nxt[base + gone], prv[here]
            sym[here], sym[base + gone] = new, -1
            nxt[here] = after
            prv[base + after] = at
            self._leaf(tree, trees, gone, LONG, width)
            self._leaf(tree, trees, at, self._key(new, sym[base + after], at, after < width), width)
            has = np.nonzero(before < width)[0]
            mine = before[has]
            self._leaf(tree, trees[has], mine, self._key(sym[base[has] + mine], new[has], mine, True), width)
            rows = rows[tree[trees + 1] < LONG]
        sym = sym.reshape(n, wide)[:, :width]
        keep = sym >= 0
        ids, ends = list(map(self.ints.__getitem__, sym[keep].tolist())), np.cumsum(keep.sum(1)).tolist()
        return [tuple(ids[a:b]) for a, b in zip([0, *ends], ends)]

    def _merge_one(self, raw: bytes, width: int) -> tuple[int, ...]:
        """One word's tree in plain numbers; -1 links to the word's ends."""
        n, ranks = len(raw), self.ranks
        sym = [*self.inner[list(raw[:-1])].tolist(), int(self.last[raw[-1]])] if n else []
        nxt, prv = [*range(1, n), -1], list(range(-1, n - 1))
        tree = [LONG] * (2 * width)

        def key(i: int, j: int) -> int:
            rank = ranks.get(sym[i] << 20 | sym[j]) if sym[i] >= 0 <= sym[j] else None
            return LONG if rank is None else rank * PLACE + i

        def leaf(i: int, value: int) -> None:
            node = i + width
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b

        tree[width : width + n - 1] = [key(i, i + 1) for i in range(n - 1)]
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < LONG:
            rank, at = divmod(tree[1], PLACE)
            gone = nxt[at]
            after, before = nxt[gone], prv[at]
            sym[at], sym[gone], nxt[at] = int(self.merged[rank]), -1, after
            leaf(gone, LONG)
            if after >= 0:
                prv[after] = at
            leaf(at, key(at, after) if after >= 0 else LONG)
            if before >= 0:
                leaf(before, key(before, at))
        return tuple(x for x in sym if x >= 0)

    def _key(self, left, right, place, there):
        rank = self.pairs(left, right)
        return np.where((rank < NO_PAIR) & (left >= 0) & (right >= 0) & there, rank * PLACE + place, LONG)

    @staticmethod
    def _leaf(tree, trees, place, value, width):
        """Set one leaf of each tree and repair its path to the root."""
        node = place + width
        tree[trees + node] = value
        while width > 1:
            node, width = node >> 1, width >> 1
            child = trees + 2 * node
            tree[trees + node] = np.minimum(tree[child], tree[child + 1])

    def _known(self, chunks: set[str]) -> dict[str, tuple[int, ...]]:
        """The ids of chunks; the words of new ones are merged, and all are remembered."""
        young, old, fresh = self.young, self.old, []
        for c in chunks - young.keys():
            ids = old.get(c)
            if ids is None:
                fresh.append(c)
            else:
                young[c] = ids
        split = [self.words(x) for x in map(self.normal, fresh)]
        words = list(set(chain.from_iterable(split)))
        merged = dict(zip(words, self.merge(words)))
        for c, ws in zip(fresh, split):
            young[c] = merged[ws[0]] if len(ws) == 1 else tuple(chain.from_iterable(map(merged.__getitem__, ws)))
        if len(young) > CACHE_WORDS:
            self.old, self.young = young, {}
        return young

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        parts = []
        for text in texts:
            at, mine = 0, []
            if self.cut:
                for m in self.cut.finditer(text):
                    mine += [self.chunks(text[at : m.start()]), self.specials[m.group()]]
                    at = m.end()
            mine.append(self.chunks(text[at:] if at else text))
            parts.append(mine)
        seen: set[str] = set()
        for x in chain.from_iterable(parts):
            if isinstance(x, list):
                seen.update(x)
        known = self._known(seen).__getitem__
        return [list(chain.from_iterable(chain.from_iterable(map(known, x)) if isinstance(x, list) else (x,) for x in mine)) for mine in parts]

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, special ones among them, with a blank between any two: this vocabulary names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a file, built once in each worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def chunks(texts: list[str], chars: int = 2_000_000):
    """Runs of texts of about so many characters, so that a batch's words fit in memory whatever the texts' lengths."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


SCHEMA = "doc_id long, ids array<int>, decoded string"


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Rows (doc_id, ids, decoded), one per input row; a null text is an empty one and gives no ids."""

    def run(batches):
        c = codec(path or vocabulary())  # where the worker has it
        for b in batches:
            at = 0
            for texts in chunks([t or "" for t in b.column(1).to_pylist()]):
                ids = c.encode_batch(texts)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(ids, pa.list_(pa.int32())), pa.array(map(c.decode, ids), pa.string())], names=["doc_id", "ids", "decoded"])
                at += len(texts)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, SCHEMA)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """As encode(), with digests of the ids and of the decoded text, worked out where the ids are."""

    def run(batches):
        c = codec(path or vocabulary())  # where the worker has it
        for b in batches:
            at = 0
            for texts in chunks([t or "" for t in b.column(1).to_pylist()]):
                ids = c.encode_batch(texts)
                hashes = [hashlib.sha256(" ".join(map(c.numbers.__getitem__, i)).encode()).hexdigest() for i in ids]
                decoded = [hashlib.sha256(c.decode(i).encode()).hexdigest() for i in ids]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(map(len, ids), pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                at += len(texts)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
