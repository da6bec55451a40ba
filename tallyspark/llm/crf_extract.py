"""Main-text extraction with a linear-chain conditional random field.

A page is cut into leaf blocks (runs of text between block-level tags), each
with its open block tags.  Features are the ancestor tags, words of their
class, id and role, and properties of the text (length, share of link text,
sentence ends).  The field has two labels, boilerplate and main text; it is
trained by gradient ascent with a Gaussian prior on a bounded number of pages
(``MAX_TRAIN``, of at most ``MAX_PAGE`` characters) that label themselves: pages
that mark their article or, if no page of the table does, any pages by their
blocks of prose.  Viterbi decodes every page.

Rows: a null, empty or text-free page gives an empty text and 0 characters;
repeated rows give one row each; a null page_id or url is carried through; an
empty table gives an empty result; other columns are not read.  Pages of any
length are decoded whole.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_TRAIN = 300
MAX_PAGE = 200_000
PROSE = 60  # characters of a block that counts as prose
STEPS = 60

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var br wbr img".split()
)
SILENT = frozenset("script style noscript template title head iframe object svg select textarea button".split())
RAW = frozenset("script style textarea title".split())
CLOSES_SELF = frozenset("p li dt dd tr td th option".split())

# Words of class, id and role that name boilerplate.
BOILER_TAGS = frozenset("nav footer aside form header menu dialog".split())
BOILER_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb comment comments cookie copyright footer header login menu nav navbar "
    "navigation newsletter notice pagination popup promo related replies share sidebar social sponsor sponsored subscribe "
    "tags toolbar widget".split()
)
MAIN_TAGS = frozenset("article main".split())
MAIN_WORDS = frozenset("article body content entry main post story text".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)"
    r"(?P<attr>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>",
    re.DOTALL,
)
NAMES = re.compile(r"(?:\b(?:class|id|role)\s*=\s*)(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORD = re.compile(r"[a-z]+")


def leaf_blocks(page: str) -> list[tuple[str, int, tuple]]:
    """(text, characters inside links, ancestors) of the leaf blocks in page
    order; an ancestor is (tag, words of class, id and role)."""
    out, stack, buffer = [], [], []
    silent = links = linked = 0
    at, lower = 0, None

    def flush():
        nonlocal linked
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append((text, linked, tuple(stack)))
        linked = 0

    def close(tag):
        nonlocal silent
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == tag:
                silent -= sum(t in SILENT for t, _ in stack[k:])
                del stack[k:]
                return

    while True:
        m = TOKEN.search(page, at)
        if not silent:
            piece = page[at : m.start() if m else len(page)]
            buffer.append(piece)
            linked += len(piece) if links else 0
        if m is None:
            break
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "br":
                buffer.append(" ")
            elif tag == "a":
                links = 0 if m["end"] else 1
            continue
        flush()
        links = 0
        if m["end"]:
            close(tag)
            continue
        if tag in VOID:
            continue
        if tag in CLOSES_SELF and stack and stack[-1][0] == tag:
            close(tag)
        if tag == "body" and silent:  # a head that was never closed
            close("head")
        elif stack and stack[-1][0] == "p":
            close("p")
        words = frozenset(WORD.findall(" ".join(a or b or c for a, b, c in NAMES.findall(m["attr"])).lower()))
        if m["attr"].endswith("/") and tag not in RAW:
            continue
        stack.append((tag, words))
        silent += tag in SILENT
        if tag in RAW:
            lower = lower if lower is not None else page.lower()
            end = lower.find(f"</{tag}", at)
            at = len(page) if end < 0 else end
    flush()
    return out


def features(block: tuple[str, int, tuple]) -> list[str]:
    text, linked, stack = block
    out = ["bias"]
    for tag, words in stack:
        out.append(f"tag {tag}")
        if words & BOILER_WORDS:
            out.append("boiler word")
        if words & MAIN_WORDS:
            out.append("main word")
        if tag in BOILER_TAGS:
            out.append("boiler tag")
        if tag in MAIN_TAGS:
            out.append("main tag")
    if stack:
        out.append(f"leaf {stack[-1][0]}")
    out.append(f"length {min(6, len(text).bit_length() // 2)}")
    out.append(f"linked {int(4 * min(1.0, linked / len(text)))}")
    out.append("ends" if text[-1] in ".!?…\"'”»" else "open")
    return sorted(set(out))


# Prior means of the main-text weights (boilerplate is the other label).
PRIOR = {"boiler tag": -6.0, "boiler word": -6.0, "main tag": 3.0, "main word": 1.0, "linked 4": -2.0, "linked 3": -1.0}


class Field:
    """Two-label linear chain: emission weights by feature, 2 x 2 transitions."""

    def __init__(self, weights: dict[str, float], trans):
        self.weights, self.trans = weights, np.asarray(trans, float)

    def scores(self, blocks) -> np.ndarray:
        return np.array([sum(self.weights.get(f, PRIOR.get(f, 0.0)) for f in features(b)) for b in blocks])

    def viterbi(self, blocks) -> list[int]:
        if not blocks:
            return []
        t, back, best = self.trans, [], (0.0, float(0))
        s = self.scores(blocks)
        best = (0.0, float(s[0]))
        for x in s[1:]:
            step, at = [], []
            for j in (0, 1):
                a, b = best[0] + t[0, j], best[1] + t[1, j]
                at.append(int(b > a))
                step.append(max(a, b) + (x if j else 0.0))
            back.append(at)
            best = tuple(step)
        label = [int(best[1] > best[0])]
        for at in reversed(back):
            label.append(at[label[-1]])
        return label[::-1]


def own_labels(blocks) -> list[int]:
    """Labels of a page that marks its article: inside article or main, and
    inside nothing that names boilerplate."""
    out = []
    for _, _, stack in blocks:
        tags = {t for t, _ in stack}
        words = frozenset().union(*(w for _, w in stack)) if stack else frozenset()
        out.append(int(bool(tags & MAIN_TAGS) and not tags & BOILER_TAGS and not words & BOILER_WORDS))
    return out


def prose_labels(blocks) -> list[int]:
    """Labels of a page without marks: sentences of some length, few links,
    inside nothing that names boilerplate."""
    out = []
    for text, linked, stack in blocks:
        tags = {t for t, _ in stack}
        words = frozenset().union(*(w for _, w in stack)) if stack else frozenset()
        prose = len(text) >= PROSE and text[-1] in ".!?…\"'”»" and 4 * linked < len(text)
        out.append(int(prose and not tags & BOILER_TAGS and not words & BOILER_WORDS))
    return out


def page_labels(blocks) -> list[int]:
    marks = any(t in MAIN_TAGS for _, _, stack in blocks for t, _ in stack)
    return own_labels(blocks) if marks else prose_labels(blocks)


def fit(pages: list[str], steps: int = STEPS, spread: float = 2.0, rate: float = 0.5) -> Field:
    """MAP weights by full-batch gradient ascent (AdaGrad steps)."""
    names: dict[str, int] = {f: i for i, f in enumerate(PRIOR)}
    data = []
    for page in pages:
        blocks = leaf_blocks(page or "")
        labels = page_labels(blocks)
        if any(labels):
            rows = [[names.setdefault(f, len(names)) for f in features(b)] for b in blocks]
            data.append((rows, np.array(labels)))
    prior = np.array([PRIOR.get(f, 0.0) for f in names])
    w, t = prior.copy(), np.zeros((2, 2))
    gw, gt = np.full(len(w), 1e-6), np.full((2, 2), 1e-6)
    for _ in range(steps if data else 0):
        dw, dt = -(w - prior) / spread**2, -t / spread**2
        for rows, y in data:
            e = np.zeros((len(rows), 2))
            e[:, 1] = [w[r].sum() for r in rows]
            fwd, bwd = e.copy(), np.zeros_like(e)
            for k in range(1, len(e)):
                fwd[k] += np.logaddexp(fwd[k - 1, 0] + t[0], fwd[k - 1, 1] + t[1])
            for k in range(len(e) - 2, -1, -1):
                bwd[k] = np.logaddexp(t[:, 0] + e[k + 1, 0] + bwd[k + 1, 0], t[:, 1] + e[k + 1, 1] + bwd[k + 1, 1])
            z = np.logaddexp(fwd[-1, 0], fwd[-1, 1])
            p = np.exp(fwd[:, 1] + bwd[:, 1] - z)
            for r, d in zip(rows, y - p, strict=True):
                dw[r] += d
            pair = np.exp(fwd[:-1, :, None] + t + (e[1:] + bwd[1:])[:, None, :] - z).sum(axis=0)
            dt -= pair
            np.add.at(dt, (y[:-1], y[1:]), 1)
        gw, gt = gw + dw**2, gt + dt**2
        w, t = w + rate * dw / np.sqrt(gw), t + rate * dt / np.sqrt(gt)
    return Field(dict(zip(names, w.tolist(), strict=True)), t)


def training_pages(pages: DataFrame, most: int = MAX_TRAIN, longest: int = MAX_PAGE) -> list[str]:
    """At most ``most`` pages that mark their article (any, if none does), by a
    hash of page_id.  The ids are chosen first, so no more than ``most`` pages
    of ``longest`` characters leave their tasks."""
    fit_for_it = pages.filter(F.col("page_id").isNotNull() & F.length("html").between(1, longest))
    for rows in (fit_for_it.filter(F.col("html").rlike("(?i)<(article|main)[ >]")), fit_for_it):
        ids = rows.select("page_id").distinct().orderBy(F.xxhash64("page_id")).limit(most).collect()
        if ids:
            chosen = F.broadcast(pages.sparkSession.createDataFrame(ids, "page_id long"))  # ``most`` rows
            once = rows.join(chosen, "page_id", "left_semi").groupBy("page_id").agg(F.min("html").alias("html"))
            return [r["html"] for r in once.orderBy(F.xxhash64("page_id")).select("html").collect()]
    return []


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url, text, n_chars per row of ``pages``."""

    def run(batches):
        for b in batches:
            texts = []
            for page in b.column("html").to_pylist():
                blocks = leaf_blocks(page or "")
                texts.append(" ".join(x[0] for x, y in zip(blocks, field.viterbi(blocks), strict=True) if y))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def extract_main_text(pages: DataFrame, most: int = MAX_TRAIN) -> DataFrame:
    return extract(pages, fit(training_pages(pages, most)))
