"""Main text of web pages: a linear-chain conditional random field over DOM leaf blocks.

A page is cut into blocks of text at block-level tags. A block's features are its ancestors'
tags, class, id and role words, and the look of its text (length, share of links, marks).
The field scores each block as main text or not and each pair of neighbours; Viterbi finds
the best labelling. It is trained on the pages themselves: those with an ``article`` or
``main`` element label their own blocks, and on half of them the ancestors are hidden, so
that text and neighbours must decide. Weights are pulled towards a prior that knows common
names of page parts, for parts that no training page has.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm import tokens as T
from recordmill.llm.training import fit_in_task, fraction_below

MAX_TRAIN_ROWS = 1_500  # pages
MAX_TRAIN_BLOCKS = 400  # longer pages are no training pages
BITS = 14
DEPTH = 24  # nearest open elements whose names are all features; names of PRIOR are at any depth
NAMES = 12  # of an attribute, besides those of PRIOR

# Element and class names of HTML practice.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg math".split())
CLOSES_ITSELF = frozenset("p li dt dd tr td th option".split())
MAIN_TAGS = ("article", "main")
#: Prior weights. Page parts outweigh the article around them.
PRIOR = {
    2.0: "t:article t:main c:article c:content c:post c:entry c:body c:story r:main",
    0.7: "t:p t:h1",
    -12.0: "t:nav t:footer t:aside t:form t:menu t:dialog t:button t:select t:fieldset t:head "
          "c:ad c:ads c:advert c:adverts c:advertisement c:sponsor c:sponsored c:promo c:promotion c:banner "
          "c:nav c:navbar c:navigation c:menu c:breadcrumb c:breadcrumbs c:sidebar c:aside c:widget c:footer "
          "c:comment c:comments c:reply c:replies c:disqus c:respond c:cookie c:cookies c:consent c:gdpr c:notice c:alert "
          "c:popup c:modal c:overlay c:newsletter c:subscribe c:subscription c:signup c:login c:share c:sharing c:social "
          "c:related c:recommended c:form c:search c:legal c:copyright c:skip c:toolbar c:pagination c:pager "
          "r:navigation r:banner r:contentinfo r:complementary r:search r:form r:dialog r:alert r:alertdialog r:menu r:menubar",
    -8.0: "t:header c:header c:masthead c:topbar",
}
KNOWN = frozenset(f for names in PRIOR.values() for f in names.split())
_TAG = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_NAME = re.compile(r"[A-Za-z]++")


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) & ((1 << BITS) - 1)


def _tag_end(page: str, at: int) -> int:
    """The position of the ``>`` that ends the tag begun at ``at``; quoted ones do not. The page's end if none does."""
    end = page.find(">", at)
    if end < 0:
        return len(page)
    quote = page.rfind("=", at, end)
    while quote >= 0 and end >= 0:
        rest = page[quote + 1 : end].lstrip()
        if rest[:1] in ("'", '"') and rest[0] not in rest[1:]:  # an open value goes on
            close = page.find(rest[0], end)
            if close < 0 or page.find("<", end, close) >= 0 and close - end > 2000:
                return end
            end, quote = page.find(">", close), page.rfind("=", close, page.find(">", close))
        else:
            break
    return end if end >= 0 else len(page)


def blocks(page: str) -> list[tuple[str, list[str], float, bool]]:
    """``(text, ancestor features, share of text in links, main by markup)`` of each leaf block."""
    out: list[tuple[str, list[str], float, bool]] = []
    stack: list[tuple[str, list[str]]] = []
    count: dict[str, int] = {}
    around: dict[str, int] = {}  # names of PRIOR on all open elements
    text: list[str] = []
    linked = size = 0
    n, at = len(page), 0

    def flush():
        nonlocal linked, size
        if text:
            words = " ".join("".join(text).split())
            if words:
                names = list(dict.fromkeys(f for _, own in stack[-DEPTH:] for f in own))
                names += [f for f in around if f not in names]
                inside = any(count.get(t) for t in MAIN_TAGS)
                out.append((words, names, linked / max(size, 1), inside))
            text.clear()
            linked = size = 0

    def close(name: str):
        while stack:
            top, own = stack.pop()
            count[top] -= 1
            for f in KNOWN.intersection(own):
                around[f] -= 1
                if not around[f]:
                    del around[f]
            if top == name:
                break

    while at < n:
        tag = page.find("<", at)
        if tag < 0:
            tag = n
        if tag > at:
            piece = page[at:tag]
            piece = html.unescape(piece) if "&" in piece else piece
            text.append(piece)
            size += len(piece)
            if count.get("a"):
                linked += len(piece)
        if tag == n:
            break
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = n if end < 0 else end + 3
            continue
        ending = page.startswith("/", tag + 1)
        m = _TAG.match(page, tag + 1 + ending)
        if not m:
            if page[tag + 1 : tag + 2] in ("!", "?", "/"):
                end = page.find(">", tag)
                at = n if end < 0 else end + 1
            else:
                text.append("<")
                size += 1
                at = tag + 1
            continue
        name = m[0].lower()
        end = _tag_end(page, m.end())
        at = min(end + 1, n)
        if name not in INLINE:
            flush()
        if ending:
            if count.get(name):
                close(name)
            continue
        if name in RAW and not page.endswith("/", tag, end):
            stop = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = n if stop is None else min(_tag_end(page, stop.end()) + 1, n)
            continue
        if name in VOID or page.endswith("/", tag, end) and name in ("svg", "path"):
            continue
        if name in CLOSES_ITSELF and count.get(name) and all(t in INLINE or t == name for t, _ in stack[-4:]):
            close(name)
        elif name not in INLINE and stack and stack[-1][0] == "p":
            close("p")
        own = [f"t:{name}"]
        for kind, *values in _ATTRIBUTE.findall(page, m.end(), end):
            prefix = "r:" if kind.lower() == "role" else "c:"
            names = [prefix + w.lower() for v in values for w in _NAME.findall(v)]
            own += names[:NAMES] + [f for f in names[NAMES:] if f in KNOWN]
        stack.append((name, own))
        count[name] = count.get(name, 0) + 1
        for f in KNOWN.intersection(own):
            around[f] = around.get(f, 0) + 1
    flush()
    return out


def features(page_blocks: list, hidden: bool = False) -> list[list[int]]:
    """Feature buckets of each block; ``hidden`` leaves the ancestors out."""
    out = []
    last = len(page_blocks) - 1
    for i, (text, names, links, _) in enumerate(page_blocks):
        words = text.count(" ") + 1
        marks = sum(text.count(c) for c in ".,;:!?")
        own = [
            f"n{min(words.bit_length(), 9)}", f"l{int(links * 4)}", f"m{min(int(20 * marks / words), 8)}", f"e{text[-1] in '.!?'}",
            "©" if "©" in text[:40] else "plain", f"u{text[0].isupper()}", f"f{i == 0}", f"z{i == last}",
        ]
        out.append([_bucket(f) for f in (own if hidden else own + names)] + [0])
    return out


def prior() -> np.ndarray:
    """Prior weights: one for each bucket, then the four of neighbouring labels."""
    w = np.zeros((1 << BITS) + 4)
    for value, names in PRIOR.items():
        for f in names.split():
            w[_bucket(f)] = value
    w[-4:] = 0.5, -0.5, -0.5, 0.5
    return w


def forward_backward(score: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of label 1 for each block, and the expected number of each pair of neighbouring labels."""
    n = len(score)
    emit = np.stack([np.zeros(n), score], 1)
    a, b = np.zeros((n, 2)), np.zeros((n, 2))
    a[0] = emit[0]
    for i in range(1, n):
        a[i] = emit[i] + np.logaddexp(a[i - 1, 0] + step[0], a[i - 1, 1] + step[1])
    for i in range(n - 2, -1, -1):
        v = emit[i + 1] + b[i + 1]
        b[i] = np.logaddexp(step[:, 0] + v[0], step[:, 1] + v[1])
    total = np.logaddexp(a[-1, 0], a[-1, 1])
    pairs = np.exp(a[:-1, :, None] + step + (emit + b)[1:, None, :] - total).sum(0) if n > 1 else np.zeros((2, 2))
    return np.exp(a[:, 1] + b[:, 1] - total), pairs


def viterbi(score: list[float], step: np.ndarray) -> list[int]:
    """The best labelling. Ties take label 0."""
    s00, s01, s10, s11 = step.ravel().tolist()
    v0, v1, back = 0.0, score[0] if score else 0.0, []
    for s in score[1:]:
        a = (v0 + s00, 0) if v0 + s00 >= v1 + s10 else (v1 + s10, 1)
        b = (v0 + s01, 0) if v0 + s01 >= v1 + s11 else (v1 + s11, 1)
        back.append((a[1], b[1]))
        v0, v1 = a[0], b[0] + s
    label = int(v1 > v0)
    out = [label]
    for pair in reversed(back):
        label = pair[label]
        out.append(label)
    return out[::-1] if score else []


def _markup_labels(page_blocks: list) -> np.ndarray:
    """1 for blocks inside an article or main element and in no part that the prior knows as none."""
    against = {f for value, names in PRIOR.items() if value < 0 for f in names.split()}
    return np.array([float(inside and not against.intersection(names)) for _, names, _, inside in page_blocks])


def fit(pages: list[list], epochs: int = 3, rate: float = 0.2, pull: float = 1e-3) -> np.ndarray:
    """Weights by AdaGrad on the pages' conditional likelihood, pulled towards the prior."""
    base = prior()
    w, g2 = base.copy(), np.full(len(base), 1.0)
    for epoch in range(epochs):
        for number, page in enumerate(pages):
            labels = _markup_labels(page)
            rows = features(page, hidden=(number + epoch) % 2 == 1)
            own = np.concatenate([np.array(r) for r in rows])
            block = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
            p, pairs = forward_backward(np.bincount(block, w[own], len(rows)), w[-4:].reshape(2, 2))
            used, back = np.unique(own, return_inverse=True)
            grad = np.bincount(back, (p - labels)[block], len(used))
            for k, (a, b) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
                pairs[a, b] -= float(((labels[:-1] == a) & (labels[1:] == b)).sum())
            used, grad = np.concatenate([used, len(w) - 4 + np.arange(4)]), np.concatenate([grad, pairs.ravel()])
            grad = grad / len(rows) + pull * (w[used] - base[used])
            g2[used] += grad * grad
            w[used] -= rate * grad / np.sqrt(g2[used])
    return w


def train(pages: DataFrame, max_train_rows: int = MAX_TRAIN_ROWS) -> np.ndarray:
    """Weights from a bounded sample, chosen by a hash, of ``pages(url, html)`` with an article or main element."""

    def run(batches):
        found = []
        for part in T.chunks(batches, "html"):
            for page in part.column(0).to_pylist():
                own = blocks(page)
                if 0 < len(own) <= MAX_TRAIN_BLOCKS:
                    found.append((zlib.crc32(page.encode()), own))
        return fit([own for _, own in sorted(found, key=lambda x: (x[0], x[1]))]).tobytes()

    usable = pages.where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    share = min(1.0, max_train_rows / max(usable.count(), 1))
    sample = usable.withColumn("key", F.xxhash64("html")).where(fraction_below("key", share, 9)).select("html").distinct()
    return np.frombuffer(fit_in_task(sample, run), np.float64)


def main_text(page: str | None, w: np.ndarray) -> str:
    """The blocks labelled main, in page order, joined by one space; null is empty."""
    own = blocks(page or "")
    labels = viterbi([float(w[r].sum()) for r in features(own)], w[-4:].reshape(2, 2))
    return " ".join(b[0] for b, label in zip(own, labels) if label)


def extract(pages: DataFrame, w: np.ndarray) -> DataFrame:
    """``page_id, url, text`` for each row of ``pages(page_id, url, html)``.

    ``text`` is never null: a null or empty page, or one without main text, gives an empty one.
    """
    shared = pages.sparkSession.sparkContext.broadcast(w)

    def run(batches: Iterator[pa.RecordBatch]):
        for part in T.chunks(batches, "html"):
            texts = [main_text(page, shared.value) for page in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    ids = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("url").cast("string").alias("url"), "html").mapInArrow(run, f"page_id {ids}, url string, text string")
