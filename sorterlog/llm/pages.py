"""Main text of web pages as a maximum-scoring subsequence.

A page becomes a sequence of tags and pieces of text. Elements that never hold
article text (scripts, menus, forms, adverts, comments and the like, told by
name, class, id or role) are passed over as a whole. A class or id token tells
that if it is a word of design, alone or followed by no more than words for
boxes (`sidebar`, `site-footer`, `comment-list`, but not `share-price` or
`comments-open`). A form around half of the page's words or more is a wrapper and stays.
Of the rest, each word scores one and each tag a negative
weight; one linear scan finds the stretch with the largest sum, and its text is
the main text. Letters of scripts that are written without blanks count as a word each. A page whose only articles stand in passed-over wrappers is read
with and without these articles, and the longer text is taken.

The weights come from labelled pages, those whose markup has exactly one
`article` or `main` element: a tag's weight grows with how much more often it
stands outside that element than inside. The element's own tags cost nothing
when a page is read, and tags between two such elements cost at most one word
each, as do other tags inside one, so several articles of a page stay together. Tags for parts of a text (lists, tables, captions) that no labelled
page shows, or that stand inside such an element, cost less than a word. Counts per tag are summed in Spark over a
bounded sample of pages. Without any labelled page the default weights hold.

Character references are decoded, white space inside a block is one space,
blocks are joined by one space. Null pages count as empty; a page without text
gives an empty string. Repeated rows give equal results. Markup that is cut
off or not closed ends with the page. Long pages are read whole; of equal sums the earliest stretch counts, and the longest of those.
An empty table gives an empty one, and only the three chosen columns are read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorterlog.llm.shared import col, prepare
from sorterlog.sources.staging import stage

MAX_FIT_PAGES = 20_000
WORDS = 200.0
LEAST = 0.05

# Names of HTML and words of page design.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
CONTENT = frozenset(("article", "main"))
NEVER = frozenset(
    "script style textarea title xmp iframe noembed noframes noscript template svg math object canvas audio video nav aside form label legend button select datalist option "
    "dialog menu head map".split()
)
OUTSIDE_ONLY = frozenset(("header", "footer"))
DESIGN = frozenset(
    "ad ads advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login sidebar menu menus nav navbar navigation navigate breadcrumb breadcrumbs footer comment comments commentlist "
    "reply replies respond disqus share sharing social related recommended widget search pagination pager toolbar skip hidden".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
COMMENTS = frozenset("comment comments commentlist reply replies".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^<>\"']|\"[^\"<]*\"|'[^'<]*')*|[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?:^|\s)(hidden)(?=\s|=|$)", re.I)
PART = re.compile(r"[a-z0-9]+")
ARTICLE = re.compile(r"<article\b", re.I)
LAYOUT = frozenset("no has with without layout".split())
BOXES = frozenset("area bar block box buttons container form icons inner item items link links list panel posts section slot top bottom unit wrap wrapper".split())
#: Weights of tags for parts of a text where no labelled page has them.
PARTS_OF_TEXT = frozenset("li ul ol dl dt dd figure figcaption table thead tbody tr td th blockquote pre section h1 h2 h3 h4 h5 h6".split())
PART_WEIGHT = -0.4
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
TAG = re.compile(r"<[^>]*>")
END_OF = {name: re.compile(rf"</{name}\b", re.I) for name in RAW}


def design_parts(value: str) -> set[str]:
    """Words of design that class or id tokens of `value` name, those that only name a layout (`has-sidebar`) or something else (`share-price`) left out."""
    words: set[str] = set()
    for token in value.split():
        parts = PART.findall(token)
        if LAYOUT.intersection(parts):
            continue
        at = next((i for i in range(len(parts)) if all(p in DESIGN or i < k and (p in BOXES or p.isdigit()) for k, p in enumerate(parts) if k >= i)), None)
        if at is not None:
            words.update(p for p in parts[at:] if p in DESIGN)
    return words


def count_words(text: str) -> int:
    """Words between blanks; letters of scripts without blanks count singly."""
    n = len(text.split())
    return n if text.isascii() else n + len(UNSPACED.findall(text))


def wraps_page(page: str, at: int) -> bool:
    """Whether a form that opens before `at` holds half of the page's words or more."""
    end = page.lower().find("</form", at)
    inner = TAG.sub(" ", page[at : end if end >= 0 else len(page)])
    return 2 * count_words(inner) >= count_words(TAG.sub(" ", page))


def is_design(name: str, rest: str, in_content: bool) -> bool:
    """Whether an element is passed over, judged by its name and attributes."""
    if name in NEVER or (name in OUTSIDE_ONLY and not in_content) or (name == "footer" and in_content):
        return True
    if name in ("html", "body") or not rest or "=" not in rest and "hidden" not in rest.lower():
        return False
    words: set[str] = set()
    for kind, *values, hidden in ATTRIBUTE.findall(rest):
        value = "".join(values).lower()
        if hidden or (kind.lower() == "role" and value in ROLES):
            return name not in CONTENT
        words |= design_parts(value)
    return bool(words & (COMMENTS if name in CONTENT else DESIGN))


def holds_articles(name: str, rest: str) -> bool:
    """Whether a passed-over element may be a mere wrapper of the page's article: told by class or id, or a form."""
    if name in NEVER - {"form"}:
        return False
    return not any(hidden or kind.lower() == "role" or design_parts("".join(values).lower()) & COMMENTS for kind, *values, hidden in ATTRIBUTE.findall(rest))


def items(page: str, rescue: bool = False) -> Iterator[tuple[str, str, bool]]:
    """Pieces of text as ("", text, in content) and tags as (name or /name, "", in content), without passed-over elements.

    `main` ends passed-over elements around it, with `rescue` also `article` where the element may be a wrapper.
    """
    stack: list[tuple[str, bool, bool]] = []  # open elements, whether each starts a passed-over part, and whether its articles stay passed over
    open_: dict[str, int] = {}
    dropped = content = sealed = 0

    def leave() -> None:
        nonlocal dropped, content, sealed
        name, drops, seals = stack.pop()
        sealed -= seals
        open_[name] -= 1
        dropped -= drops
        content -= name in CONTENT

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        text, name = m["text"], m["name"]
        if text is not None:
            if not dropped:
                yield "", text, content > 0
            continue
        if name is None:
            continue
        name = name.lower()
        if m["close"]:
            if open_.get(name):
                while stack[-1][0] != name:
                    leave()
                inside, was = content > 0, dropped
                leave()
                if not was:
                    yield "/" + name, "", inside
            elif not dropped:
                yield "/" + name, "", content > 0
            continue
        rest = m["rest"] or ""
        if name in RAW:
            found = END_OF[name].search(page, at)
            at = page.find(">", found.end()) + 1 or end if found else end
            continue
        if name not in INLINE and name not in VOID:
            while stack and (stack[-1][0] in INLINE or stack[-1][0] == "p") and open_.get("p"):
                leave()
        if dropped and (name == "main" or rescue and name == "article" and not sealed and not is_design(name, rest, False)):
            while dropped:
                leave()
        wrapper = name == "form" and not dropped and wraps_page(page, at)
        drops = not dropped and not wrapper and is_design(name, rest, content > 0)
        if not dropped and not drops:
            yield name, "", content > 0
        if name in VOID or rest.endswith("/"):
            continue
        seals = rescue and is_design(name, rest, content > 0) and not holds_articles(name, rest)
        stack.append((name, drops, seals))
        sealed += seals
        open_[name] = open_.get(name, 0) + 1
        dropped += drops
        content += name in CONTENT


@dataclass(frozen=True)
class PageModel:
    tag: dict[str, float]
    other_tag: float


DEFAULT = PageModel({"/p": -0.1, "p": -0.1, "br": -0.1, "article": -WORDS, "/article": -WORDS, "main": -WORDS, "/main": -WORDS, "li": -2.0, "a": -2.0, "td": -2.0}, -1.0)


def tag_counts(page: str) -> list[tuple[str, int, int]]:
    """For a labelled page: how often each tag (and "" for words) stands inside and outside the labelled element."""
    sequence = list(items(page))
    if sum(1 for name, _, _ in sequence if name in CONTENT) != 1:
        return []
    counts: dict[str, list[int]] = {}
    for name, text, inside in sequence:
        inside = inside and name.lstrip("/") not in CONTENT
        if not name:
            n = count_words(text)
        elif name.lstrip("/") in VOID | INLINE | CONTENT | {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "table", "tr", "td", "th", "section", "body", "html", "header", "blockquote", "pre", "figure"}:
            n = 1
        else:
            name, n = "other", 1
        counts.setdefault(name, [0, 0])[0 if inside else 1] += n
    return [(name, a, b) for name, (a, b) in counts.items()]


def fit(df: DataFrame, key: str = "page_id", page: str = "html", max_fit_pages: int = MAX_FIT_PAGES) -> PageModel:
    """Learn from at most about `max_fit_pages` pages, chosen by a hash of the key."""
    prepare(df.sparkSession)
    rows = df.select(col(key).alias("k"), col(page).alias("page")).where("page is not null")
    share = min(1.0, max_fit_pages / max(rows.count(), 1))
    chosen = rows.where(F.pmod(F.xxhash64("k", F.lit("fit")), F.lit(1 << 20)) < share * (1 << 20)).select("page")

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, list[int]] = {}
        for batch in batches:
            for text in batch["page"]:
                for name, a, b in tag_counts(text):
                    mine = total.setdefault(name, [0, 0])
                    mine[0] += a
                    mine[1] += b
        yield pd.DataFrame([(n, a, b) for n, (a, b) in total.items()], columns=["name", "inside", "outside"])

    found = stage(
        chosen.mapInPandas(counts, "name string, inside long, outside long").groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")),
        "tag-counts",
    ).collect()  # one row per known tag
    table = {r["name"]: (r["inside"], r["outside"]) for r in found}
    if not table:
        return DEFAULT
    weight = {n: -max(LEAST, min(WORDS, (b + 1) / (a + 1))) for n, (a, b) in table.items() if n}
    return PageModel(weight, weight.get("other", -1.0))


def best_stretch(scores: np.ndarray) -> tuple[int, int]:
    """First and last index of the stretch with the largest sum, the longest of the earliest ones."""
    total = np.concatenate(([0.0], np.cumsum(scores)))
    lowest = np.minimum.accumulate(total[:-1])
    end = int((total[1:] - lowest).argmax())
    start = int(np.flatnonzero(total[: end + 1] == lowest[end])[0])
    return start, end


def tag_scores(sequence: list[tuple[str, str, bool]], model: PageModel) -> np.ndarray:
    """One for each word, the learnt weight for each tag; a labelled element's own tags cost nothing, tags between two such elements one word at most."""
    own = [i for i, (name, _, _) in enumerate(sequence) if name.lstrip("/") in CONTENT]
    first, last = (own[0], own[-1]) if own else (0, 0)
    return np.array([
        count_words(text) if not name
        else 0.0 if name.lstrip("/") in CONTENT
        else max(model.tag.get(name, model.other_tag), PART_WEIGHT) if name.lstrip("/") in PARTS_OF_TEXT and (inside or name not in model.tag)
        else max(model.tag.get(name, model.other_tag), -1.0 if inside or first < i < last else -WORDS)
        for i, (name, text, inside) in enumerate(sequence)
    ], float)


def main_text(page: str | None, model: PageModel) -> str:
    page = page or ""
    sequence = list(items(page))
    found = stretch_text(sequence, model)
    if not any(name in CONTENT for name, _, _ in sequence) and ARTICLE.search(page):
        found = max(found, stretch_text(list(items(page, rescue=True)), model), key=count_words)
    return found


def stretch_text(sequence: list[tuple[str, str, bool]], model: PageModel) -> str:
    """Text of the best stretch."""
    if not sequence:
        return ""
    scores = tag_scores(sequence, model)
    if not (scores > 0).any():
        return ""
    start, end = best_stretch(scores)
    blocks, block = [], []
    for name, text, _ in sequence[start : end + 1]:
        if not name:
            block.append(text)
        elif name.lstrip("/") not in INLINE:
            blocks.append("".join(block))
            block = []
    blocks.append("".join(block))
    found = (" ".join(html.unescape(b).split()) for b in blocks)
    return " ".join(b for b in found if b)


def extract(df: DataFrame, model: PageModel, key: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of `df`: page_id, url, text and n_chars."""
    prepare(df.sparkSession)

    def each(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(p, model) for p in pages], dtype=object)

    rows = df.select(col(key).alias("page_id"), col(url).alias("url"), F.pandas_udf(each, "string")(col(page)).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("long"))
