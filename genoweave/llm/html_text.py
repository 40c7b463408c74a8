"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. Words score positive and tags negative, except where the weights learned from labelled
pages say otherwise: a word's weight is the log odds of lying in the content, by the element that holds it (name and class), a tag's the log odds of standing inside the content rather than outside,
at most a small negative number. One linear scan finds the contiguous region with the largest sum. Boilerplate elements
(menus, forms, adverts, comments, scripts ...) never count: their words score nothing and are left out, so that an
advert amid an article doesn't cut it in two.

Labelled pages are those whose markup names its content itself, by one ``article`` element; a bounded sample of them
is learned from, those whose rows have the least hashes; rows that repeat wholly share one.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose content is never text, never main text, and never closed; elements that don't end a block;
#: elements that hold a piece of running text.
SILENT = frozenset("script style noscript template svg iframe object head select option datalist textarea".split())
APART = frozenset("nav header footer aside form menu button dialog".split()) | SILENT
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RUNNING = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th tr caption figcaption address".split())
#: Words in class, id or role that mark boilerplate, and words that may stand beside them.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header menu modal nav navbar navigation newsletter notice notices popup promo "
    "promoted promotion related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
BESIDE = frozenset(
    "area article articles bar bottom box button buttons container content form global header inner item items label left link links list main media middle module outer overlay page panel post posts primary reader right row "
    "secondary section site slot stories story text thread title top unit user wrap wrapper".split()
)
#: A tag: quotes count after an equals sign only. All parts are possessive, so it is matched or refused in linear time.
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?")
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in ("script", "style", "textarea", "iframe")}
_PARTS = re.compile(r"[a-z]+")
#: An open paragraph, item or cell ends where one of these begins.
_CLOSES = {"p": frozenset("p ul ol li div h1 h2 h3 h4 h5 h6 table section article aside nav header footer form pre blockquote hr main".split()), "li": frozenset(["li"]), "tr": frozenset(["tr"]), "td": frozenset("td th tr".split()), "th": frozenset("td th tr".split()), "dt": frozenset("dt dd".split()), "dd": frozenset("dt dd".split()), "option": frozenset(["option"])}


class Token:
    """A tag (``words`` is 0) or a run of text. ``key`` names the element, ``held`` that it is inside boilerplate."""

    __slots__ = ("article", "block", "held", "key", "text", "words")

    def __init__(self, key: str, text: str, words: int, held: bool, block: bool, article: bool):
        self.key, self.text, self.words, self.held, self.block, self.article = key, text, words, held, block, article


def _marks(names: str) -> bool:
    """True if one of the names (of a class, id or role) marks boilerplate: it has a marking word, and no word but such
    and those that may stand beside them ('related-posts' marks, 'notice-of-motion' doesn't)."""
    for name in names.split():
        parts = _PARTS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
        if any(x in MARKED for x in parts) and all(x in MARKED or x in BESIDE for x in parts):
            return True
    return False


def _key(name: str, attributes: str) -> tuple[str, bool, bool]:
    """An element's key (name and first class), whether it is boilerplate by its nature, and whether by its mark."""
    if name in APART:
        return f"!{name}", True, False
    first, marked = "", False
    if attributes.strip(" /"):
        for k, v in _ATTRIBUTE.findall(attributes):
            k, v = k.lower(), v.strip("\"'")
            if k == "hidden" or (k == "aria-hidden" and v == "true"):
                return "!hidden", True, False
            if k in ("class", "id", "role"):
                first = first or (v.split() or [""])[0].lower()
                marked = marked or _marks(v)
    return (f"{name}.{first}" if first else name), False, marked and name not in ("html", "body", "article", "main")


def tokens(page: str, weights: dict[str, float] | None = None) -> list[Token]:
    """Tags and text runs of a page, in order, in linear time.

    Tags that don't match are closed as far as they can be; a tag, comment or script that never ends takes the rest. A marked
    element is boilerplate, but for a paragraph or other piece of running text in an article: that goes only if the weights say
    that words of such elements lie outside articles clearly more often. Without weights (None) marks hold nothing, and
    all inside a marked element has its key.
    """
    out: list[Token] = []
    open_: list[tuple[str, str, int]] = []  # name, key, 1 for boilerplate
    names: Counter = Counter()
    absent: set[str] = set()
    held = article = at = start = 0
    n, tag, inherited = len(page), _TAG, []  # inherited: depth and key of open marked elements, without weights

    def seek(what: str, place: int) -> int:
        """Where it comes next, the page's end if never."""
        k = -1 if what in absent else page.find(what, place)
        if k < 0:
            absent.add(what)
        return k + len(what) if k >= 0 else n

    def close(k: int) -> None:
        nonlocal held, article
        while len(open_) > k:
            name, key, apart = open_.pop()
            names[name] -= 1
            held -= apart
            article -= name == "article"
            out.append(Token("/" + key, "", 0, held > 0 or apart > 0, name not in INLINE, article > 0))
            if inherited and inherited[-1][0] == len(open_):
                inherited.pop()

    def text(raw: str) -> None:
        if raw:
            decoded = entities.unescape(raw) if "&" in raw else raw
            key = inherited[-1][1] if inherited else open_[-1][1] if open_ else ""
            out.append(Token(key, decoded, len(decoded.split()), held > 0, False, article > 0))

    while (lt := page.find("<", at)) >= 0:
        if page.startswith(("<!", "<?"), lt):
            text(page[start:lt])
            if page.startswith("<!--", lt):
                at = seek("-->", lt + 2)
            elif page.startswith("<![CDATA[", lt) and (end := seek("]]>", lt)) < n:
                text(page[lt + 9 : end - 3])
                at = end
            else:
                at = seek(">", lt)
            start = at
            continue
        m = tag.match(page, lt)
        if not m:
            letter = page[lt + 2 : lt + 3] if page.startswith("</", lt) else page[lt + 1 : lt + 2]
            if not (letter.isascii() and letter.isalpha()):  # a character like any other
                at = lt + 1
                continue
            tag = _LOOSE  # a quote never ends; from here on quotes don't count
            m = tag.match(page, lt)
            if not m:
                text(page[start:lt])
                start = n
                break
        text(page[start:lt])
        start = at = m.end()
        name = m[2].lower()
        if m[1]:
            if names[name] > 0:
                close(next(i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name))
            continue
        while open_ and name in _CLOSES.get(open_[-1][0], ()):
            close(len(open_) - 1)
        key, apart, marked = _key(name, m[3])
        if marked:
            if weights is None:
                inherited.append((len(open_), key))
            else:
                seen = weights.get("word " + key)
                apart = not article or name not in RUNNING or seen is not None and seen < -1
        if name in ("article", "main") and held and all(x[0] == "form" for x in open_ if x[2]):  # a form around the page
            open_[:] = [(*x[:2], 0) for x in open_]
            held = 0
        out.append(Token(inherited[-1][1] if inherited else key, "", 0, held > 0 or apart, name not in INLINE, article > 0))
        if name in VOID or _SELF_CLOSED.search(m[3]) and name not in _END:
            if inherited and inherited[-1][0] == len(open_):
                inherited.pop()
            continue
        open_.append((name, key, int(apart)))
        names[name] += 1
        held += apart
        article += name == "article"
        if name in _END:
            end = _END[name].search(page, at)
            at = start = end.start() if end else n
    text(page[start:])
    close(0)
    return out


def region(found: list[Token], weights: dict[str, float]) -> tuple[int, int]:
    """The contiguous region of tokens with the largest sum, from the first such one; (0, 0) if no sum is positive."""
    best, total, start, span = 0.0, 0.0, 0, (0, 0)
    for i, t in enumerate(found):
        if t.held:
            total += 0 if t.text else TAG
        elif t.words:
            total += t.words * weights.get("word " + t.key, WORD)
        elif not t.text:
            total += min(TAG, weights.get("tag " + t.key, TAG))
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, span = total, (start, i + 1)
    return span


#: Weights without evidence: of a word, and the least cost of a tag.
WORD, TAG = 1.0, -0.05


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """The text of the best region without boilerplate: blocks with single spaces, joined by one."""
    found = tokens(page, weights) if page else []
    start, end = region(found, weights)
    parts: list[str] = []
    for t in found[start:end]:
        if t.block:
            parts.append(" ")
        elif t.text and not t.held:
            parts.append(t.text)
    return " ".join("".join(parts).split())


def evidence(page: str | None) -> Counter:
    """Of a page with content in one article: how many words and tags lie inside and outside, by key."""
    out: Counter = Counter()
    for t in tokens(page) if page else []:
        if t.held:
            continue
        if t.words:
            out["word " + t.key, t.article] += t.words
        elif not t.text:
            out["tag " + t.key, t.article] += 1
    return out


def learn(pages: DataFrame, *, html: str = "html", sample: int = 2000, support: int = 3) -> dict[str, float]:
    """Weights of words and tags from at most ``sample`` labelled pages, for all keys met ``support`` times or more."""
    one = F.regexp_count(F.lower("html"), F.lit("<article[\\s>]")) == 1
    rows = pages.select(F.col(html).alias("html"), F.xxhash64(*pages.columns).alias("hash")).filter(one)
    least = rows.select("hash").distinct().orderBy("hash").limit(sample)  # narrow, and at most ``sample`` rows to broadcast
    chosen = rows.join(F.broadcast(least), "hash").select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for page in b.column(0):
                total.update(evidence(page.as_py()))
        rows = [(k, inside, n) for (k, inside), n in total.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in ((0, pa.string()), (1, pa.bool_()), (2, pa.int64()))], names=["key", "inside", "n"])

    of = lambda x: F.sum(F.when(F.col("inside") == x, F.col("n")).otherwise(0))
    counts = chosen.mapInArrow(count, "key string, inside boolean, n long").groupBy("key").agg(of(True).alias("i"), of(False).alias("o"))
    return {r.key: max(-6.0, min(3.0, math.log((r.i + 0.5) / (r.o + 0.5)))) for r in counts.filter(F.col("i") + F.col("o") >= support).collect()}  # bounded by the sample's pages


def extract(pages: DataFrame, weights: dict[str, float], *, html: str = "html", out: str = "text") -> DataFrame:
    """Append the main text of each page; '' for null, empty and textless pages.

    Other columns are kept, but for one named like ``out``, which it replaces. Repeated rows are extracted one by one, texts of any
    length whole; an empty table stays empty.
    """

    @F.pandas_udf("string")
    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(x, weights) for x in batch], dtype=object)

    return pages.withColumn(out, texts(F.col(html)))
