"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is read as words and tags. Words score positive and tags negative; one linear scan finds the contiguous run of the
highest sum, which is the content region. The weights are log-odds counted on labelled pages, those that mark their article
themselves (one article or main element): how much likelier a kind of token is inside the marked part than outside. The
blocks of the region are then written out without elements that are seldom content (menus, forms, adverts, notices,
comments, recognised by element name or by a word of their class, id or role). Such an element that holds most of the
page's words is a wrapper, and is read on, if an article, a main element or a first heading is in it or nowhere; reader
comments, further reading, menus and footers may hold most of the words and count as wrappers only with a main element or a
first heading in them. Scripts and hidden elements are never read.

Null, empty and tagless pages, unclosed or cut tags, and unknown entities are all read as far as they go; whole pages are
read, whatever their length. Repeated rows give equal texts. Weights are learned for the KINDS most frequent tags; rarer
ones have default_weight().
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

KINDS = 2000  # tag kinds with learned weights: the most frequent ones
ENOUGH = 20  # occurrences on labelled pages from which a learned weight replaces the default

# Fixed lists: element names and words of class, id and role.
RAW = {"script", "style", "template", "noscript", "svg", "iframe", "textarea", "title", "object", "canvas", "math"}
SKIP = {"nav", "footer", "aside", "form", "dialog", "menu", "button", "select", "head", "header"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
MAIN = {"article", "main"}
CLOSED_BY_BLOCK = {"p", "dt", "dd", "li", "td", "th", "tr", "option"}
NOISE = (
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside "
    "widget cookie cookies consent notice gdpr popup modal overlay share sharing social comment comments discussion disqus respond replies related recommended newsletter subscribe "
    "subscription signup login toolbar pagination pager skip copyright legal search form contentinfo complementary"
).split()
APART = {"comment", "comments", "discussion", "disqus", "respond", "replies", "related", "recommended"}
NOISE_WORDS = set(NOISE)
NOISY = re.compile(r"(?<![a-z])(?:" + "|".join(NOISE) + r")(?![a-z])")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
UNSEEN = re.compile(r"(?:^|[;\s])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
TEXTUAL = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre"}  # an article's own blocks
MARKED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: A quote opens a value after = alone, and one that is never closed is a plain character: only the page's last quote of
#: each sort can be unclosed, so the scan stays linear.
LEX = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|=)*+)(?:>|\Z)", re.S)
MARKUP = re.compile(r"=\s*+(?:\"[^\"<>]*+[<>][^\"]*+\"|'[^'<>]*+[<>][^']*+')")  # values that hold pages of their own
ENDS = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*+(?:>|\Z)", re.I) for name in RAW}
WORD, LINK_WORD, SKIPPED = "w", "w a", "skip"


def events(page: str) -> list[tuple]:
    """(name, closes, attributes, text) in page order: a text has the name None. Scripts and their like are left out."""
    out: list[tuple] = []
    at, size = 0, len(page)
    while at < size:
        m = LEX.search(page, at)
        if text := page[at : m.start() if m else size]:
            out.append((None, False, "", text))
        if not m:
            break
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        closes, attrs = bool(m.group(1)), MARKUP.sub("=''", m.group(3))
        if name not in RAW:
            out.append((name, closes, attrs, ""))
        elif not closes and not attrs.endswith("/"):
            end = ENDS[name].search(page, at)
            at = end.end() if end else size
    return out


def ends_of(evs: list[tuple]) -> list[int]:
    """For each opening tag the event that ends its element: its closing tag, the next block for elements that need none,
    the body for a head, the page's end for what is never closed."""
    out, open_, block, body = [len(evs)] * len(evs), {}, len(evs), len(evs)
    for i in range(len(evs) - 1, -1, -1):
        name, closes, attrs, _ = evs[i]
        if name is None:
            continue
        if name == "body" and not closes:
            body = i
        if closes:
            open_.setdefault(name, []).append(i)
        elif attrs.endswith("/") or name in VOID:
            out[i] = i
        elif name in CLOSED_BY_BLOCK:
            out[i] = block
        else:
            mine = open_.get(name)
            out[i] = mine.pop() if mine else len(evs)
            if name == "head":
                out[i] = min(out[i], body)
        if name not in INLINE and name not in VOID:
            block = i
    return out


def tokens(page: str):
    """(kind, text) in page order. A word run has kind WORD, LINK_WORD or SKIPPED and its text; a tag has its key and ''.

    A tag's key is its name, with / before it if it closes, within <> if its element is seldom content; such an element
    gives a SKIPPED for each of its texts, unless it holds most of the page's words."""
    evs = events(page)
    ends, words = ends_of(evs), [0]
    heads, marks = [0], [0]  # main elements and first headings so far, and those with articles
    for name, closes, _, text in evs:
        words.append(words[-1] + (len(text.split()) if name is None else 0))
        heads.append(heads[-1] + (name in ("main", "h1") and not closes))
        marks.append(marks[-1] + (name in ("main", "h1", "article") and not closes))
    link, main, i = 0, 0, 0
    while i < len(evs):
        name, closes, attrs, text = evs[i]
        if name is None:
            yield (LINK_WORD if link else WORD), entities.unescape(text)
            i += 1
            continue
        if not closes and name not in VOID and not attrs.endswith("/"):
            why = _skipped(name, attrs, bool(main))
            end = ends[i]
            wraps = 2 * (words[end] - words[i]) > words[-1] and (heads[end] > heads[i] or why == "often" and (marks[end] > marks[i] or not marks[-1]))
            if why and (why == "always" or not wraps):
                yield f"<{name}>", ""
                for k in range(i + 1, end):
                    if evs[k][0] is None and not evs[k][3].isspace():
                        yield SKIPPED, ""
                i = end + (end < len(evs) and evs[end][1] and evs[end][0] == name)
                continue
        if name == "a":
            link = 0 if closes else 1
        if name in MAIN:
            main = max(0, main + (-1 if closes else 1))
        yield ("/" + name if closes else name), ""
        i += 1


def _skipped(name: str, attrs: str, inside: bool) -> str:
    """Why an element is not read: "always", or "often" for what may wrap the content, "mostly" for what hardly does."""
    if name in ("body", "html") or name in MAIN:
        return ""
    if attrs and _hidden(attrs):
        return "always"
    if attrs and (noise := _noisy(attrs, whole=name in TEXTUAL)):
        return "mostly" if noise & APART else "often"
    return "mostly" if name in ("nav", "footer") else "often" if name in SKIP and not (name == "header" and inside) else ""


def _hidden(attrs: str) -> bool:
    """Whether an element isn't shown: by an attribute of that name, aria-hidden="true", or its style. Other values don't count."""
    low = attrs.lower()
    if "hidden" not in low and "none" not in low:
        return False
    for m in ATTRIBUTE.finditer(low):
        name, value = m[1], next(filter(None, m.groups()[1:]), "")
        if name == "hidden" or name == "aria-hidden" and value.strip() == "true" or name == "style" and UNSEEN.search(value):
            return True
    return False


def _noisy(attrs: str, whole: bool = False) -> set[str]:
    """The words of the fixed list that the class, id and role hold. With `whole` a class of several parts, such as form-text, is
    none of them: it tells how a block of text looks, not what it is."""
    values = (re.sub(r"([a-z])([A-Z])", r"\1 \2", next(filter(None, m.groups()), "")).lower() for m in MARKED.finditer(attrs))
    if whole:
        return {w for v in values for w in v.split() if w in NOISE_WORDS}
    return set().union(*map(NOISY.findall, values))


def default_weight(kind: str) -> float:
    """Weights where no labelled page tells: words gain, inline tags cost little, blocks more, ends of articles most."""
    if kind in (WORD, LINK_WORD, SKIPPED):
        return {WORD: 1.0, LINK_WORD: 0.25, SKIPPED: 0.0}[kind]
    name = kind.strip("/<>")
    if name in MAIN or name in ("body", "html"):
        return -60.0
    if kind[0] == "<":
        return -0.5
    return -0.2 if name in INLINE or name == "br" else -0.5 if name in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre") else -1.5


def census(page: str) -> dict[str, list[int]]:
    """Occurrences of each kind inside and outside the marked article; empty for pages that mark none or several."""
    found: dict[str, list[int]] = {}
    inside, marks = False, 0
    for kind, text in tokens(page):
        if kind in MAIN:
            marks += 1
        if kind.strip("/") in MAIN:
            inside = kind in MAIN
            found.setdefault(kind, [0, 0])[1] += 1
            continue
        n = len(text.split()) if kind in (WORD, LINK_WORD) else 1
        if n:
            found.setdefault(kind, [0, 0])[0 if inside else 1] += n
    return found if marks == 1 else {}


def count_kinds(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Rows (kind, inside, outside) over all labelled pages; each task sends one row a kind."""

    def run(batches):
        total: dict[str, list[int]] = {}
        for b in batches:
            for page in b.column(0).to_pylist():
                for kind, (i, o) in census(page or "").items():
                    t = total.setdefault(kind, [0, 0])
                    t[0] += i
                    t[1] += o
                if len(total) > 50_000:
                    yield _rows(total)
                    total = {}
        yield _rows(total)

    return pages.select(F.col(html_col).cast("string")).mapInArrow(run, "kind string, inside long, outside long").groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


def _rows(total: dict[str, list[int]]) -> pa.RecordBatch:
    cols = [pa.array(list(total), pa.string()), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([v[1] for v in total.values()], pa.int64())]
    return pa.RecordBatch.from_arrays(cols, names=["kind", "inside", "outside"])


def learn(pages: DataFrame, html_col: str = "html") -> dict[str, float]:
    """Weights by kind. Words keep a positive sign and tags a negative one; a tag that is never inside an article is
    weighed so that no run of ordinary length gains by crossing it."""
    rows = count_kinds(pages, html_col).orderBy(F.desc(F.col("inside") + F.col("outside")), "kind").limit(KINDS).collect()
    ins, outs = sum(r["inside"] for r in rows) + 1, sum(r["outside"] for r in rows) + 1
    odds = {r["kind"]: math.log((r["inside"] + 1) / ins) - math.log((r["outside"] + 1) / outs) for r in rows if r["inside"] + r["outside"] >= ENOUGH}
    unit = max(odds.get(WORD, 0.0), 0.1)
    never = {r["kind"] for r in rows if not r["inside"]}
    weights = {}
    for kind, x in odds.items():
        x /= unit
        if kind in (WORD, LINK_WORD):
            weights[kind] = min(max(x, 0.05), 1.0)
        elif kind != SKIPPED:
            weights[kind] = min(x * (10 if kind in never and kind[0] != "<" else 1), default_weight(kind) if kind in never else -0.05)
            if kind[0] == "<":
                weights[kind] = max(weights[kind], -0.5)  # skipped elements lie within articles too
    return weights


def best_run(values: list[float]) -> tuple[int, int]:
    """First and end of the contiguous run of the highest sum, the first of equals; an empty run if no sum is over zero.

    >>> best_run([1.0, -2.0, 3.0, -1.0, 2.0])
    (2, 5)
    """
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for i, x in enumerate(values):
        total += x
        if total > best:
            best, found = total, (start, i + 1)
        elif total <= 0:
            total, start = 0.0, i + 1
    return found


def _within_article(toks: list[tuple[str, str]], start: int, end: int) -> tuple[int, int]:
    """The run, taken on to the ends of the page's only article (or main element, where it has no article) that it meets: a heading
    of one word or a small table at its edge costs more tags than it has words."""
    for name in ("article", "main"):
        opened = [i for i, (kind, _) in enumerate(toks) if kind == name]
        if len(opened) == 1:
            close = next((i for i in range(len(toks) - 1, opened[0], -1) if toks[i][0] == "/" + name), len(toks))
            return (min(start, opened[0]), max(end, close)) if start < close and end > opened[0] else (start, end)
        if opened:
            break
    return start, end


def extract(page: str | None, weights: dict[str, float] | None = None) -> str:
    """The main text: blocks in page order joined by line breaks, white space within a block made one blank.

    >>> extract("<nav><a>Home</a></nav><p>One  two<p>three &amp; four<footer>x</footer>")
    'One two\\nthree & four'
    """
    weights = weights or {}
    toks = list(tokens(page or ""))
    values = []
    for kind, text in toks:
        w = weights.get(kind)
        if w is None:
            w = default_weight(kind)
        values.append(w * len(text.split()) if kind in (WORD, LINK_WORD) else w)
    blocks, now, breaks = [], [], 0
    for kind, text in toks[slice(*_within_article(toks, *best_run(values)))]:
        if kind in (WORD, LINK_WORD):
            now.append(text)
            if not text.isspace():
                breaks = 0
            continue
        name = kind.strip("/<>")
        if kind == SKIPPED or name in INLINE and kind[0] != "<":
            continue
        breaks = breaks + 1 if name == "br" else 2
        if breaks >= 2:
            blocks.append("".join(now))
            now = []
        else:
            now.append(" ")
    blocks.append("".join(now))
    return "\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


def main_text(pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text), one per input row; weights are learned from the pages themselves unless given."""
    weights = learn(pages, html_col) if weights is None else weights

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([extract(p, weights) for p in b.column(2).to_pylist()], pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string")


def op3_html(spark, sf_dir: str) -> DataFrame:
    out = main_text(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
