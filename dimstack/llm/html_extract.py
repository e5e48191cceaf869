"""Main text of web pages by consensus paths per host.

Each page is parsed once, scores its containers and votes for the generalised
path (tags and classes, digits alike) of its best one.  Spark counts the votes
per host and path and joins them with the paths of the pages' shapes; a page
gives its blocks below the path with most votes among those that it has.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import join_dimension, materialize

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*>)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# HTML element names by role.
RAW = frozenset("script style textarea noscript template iframe svg math xmp title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("body article main section div td center blockquote details".split())
BLOCKS = CONTAINERS | frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr caption pre address "
                                "figure figcaption header footer nav aside form fieldset hr summary html".split())
ENDS_P = BLOCKS - {"td", "caption", "html"}
DROPPED = frozenset("nav aside footer form button select dialog menu head datalist".split())
# Words in class, id or role that mark what is not the article.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promoted "
                  "cookie cookies consent gdpr notice notices alert sidebar sidebars menu menus nav navbar navigation "
                  "breadcrumb breadcrumbs footer comment comments commentlist respond reply replies disqus share sharing "
                  "social related recommended popup modal newsletter subscribe subscription signup login widget widgets "
                  "toolbar pagination pager masthead complementary contentinfo search".split())
# Inside an article such a word marks an element only if its whole name is made
# of them: "ad-banner" does, "social-history" or "search-results" is a section.
HEADER_MARKS = frozenset("header topbar".split())
CONTENT_MARKS = frozenset("content article post entry story main text".split())
#: Pages whose blocks are passed on at a time.
PAGES = 256


def _words(attributes: dict) -> set[str]:
    named = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
    return set(re.split(r"[^a-z]+", named.lower()))


def _named_by_marks(attributes: dict) -> bool:
    """Whether one whole class, id or role consists of MARKS."""
    named = " ".join(attributes.get(k, "") for k in ("class", "id", "role")).lower().split()
    return any(parts and MARKS.issuperset(parts) for parts in ([x for x in re.split(r"[^a-z]+", n) if x] for n in named))


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(raw)}


def general_step(tag: str, attributes: dict) -> str:
    classes = sorted(set(re.sub(r"\d+", "#", attributes.get("class", "").lower()).split()))
    return tag + "".join("." + c for c in classes)


class Element:
    __slots__ = ("tag", "path", "dropped", "boost")

    def __init__(self, tag, path, dropped, boost=1.0):
        self.tag, self.path, self.dropped, self.boost = tag, path, dropped, boost


def blocks(html: str) -> Iterator[tuple[tuple[str, ...], dict[str, float], str, int]]:
    """Blocks of text in page order: (paths of the open containers from the
    outside in, their boosts, text, characters in links).  What belongs to
    dropped elements is left out."""
    stack = [Element("html", "", False)]
    text: list[str] = []
    links = linked = at = 0

    def ended():
        nonlocal text, linked
        joined = " ".join("".join(text).split())
        count, text, linked = linked, [], 0
        if joined:
            open_ = [e for e in stack if e.path and e.tag in CONTAINERS]
            return [(tuple(e.path for e in open_), {e.path: e.boost for e in open_}, joined, min(count, len(joined)))]
        return []

    def said(raw: str):
        nonlocal linked
        if raw and not stack[-1].dropped:
            raw = entities.unescape(raw) if "&" in raw else raw
            text.append(raw)
            if links:
                linked += len(raw.strip())

    while m := TAG.search(html, at):
        said(html[at:m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCKS:
                yield from ended()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            if not m[3].endswith("/>"):
                at = close.end() if close else len(html)
            continue
        if tag == "br":
            said(" ")
            continue
        if tag in BLOCKS:
            yield from ended()
            if tag in ENDS_P and stack[-1].tag == "p" or tag == "li" and stack[-1].tag == "li":
                stack.pop()
        elif tag == "td" or tag == "th":
            said(" ")
        if tag == "a":
            links += 1
        if tag in VOID or m[3].endswith("/>") and tag not in BLOCKS:
            continue
        attributes = _attributes(m[3][:-1]) if len(m[3]) > 1 else {}
        inside = any(e.tag in ("article", "main") for e in stack)
        words = _words(attributes) if attributes else set()
        dropped = (stack[-1].dropped or tag in DROPPED or (tag == "header" and not inside) or "hidden" in attributes
                   or (tag not in ("body", "article", "main") and (_named_by_marks(attributes) if inside else bool(words & (MARKS | HEADER_MARKS)))))
        if tag in CONTAINERS:
            boost = (1.5 if tag in ("article", "main") else 1.0) * (1.25 if words & CONTENT_MARKS else 1.0)
            path = next((e.path for e in reversed(stack) if e.path), "")
            stack.append(Element(tag, f"{path}/{general_step(tag, attributes)}", dropped, boost))
        elif dropped or tag in ("header", "p", "li"):
            stack.append(Element(tag, "", dropped))
    said(html[at:])
    yield from ended()


def container_scores(html: str) -> dict[str, float]:
    """Score per container path: unlinked text and commas of its own blocks,
    more for article-like containers, and part of what its children score."""
    return _scores(blocks(html))


def _scores(found: Iterable[tuple]) -> dict[str, float]:
    score: dict[str, float] = defaultdict(float)
    for paths, boosts, text, linked in found:
        worth = max(0, len(text) - 2 * linked) + 10 * text.count(",")
        for path in reversed(paths):
            score[path] += worth * boosts[path]
            worth *= 0.6
    return dict(score)


def main_text(html: str, path: str | None) -> str:
    """The blocks below the containers of one path, joined by newlines."""
    return "\n".join(text for paths, _, text, _ in blocks(html) if path in paths) if path else ""


def best_path(html: str) -> tuple[str | None, float]:
    return _best(container_scores(html))


def _best(score: dict[str, float]) -> tuple[str | None, float]:
    best = min(score, key=lambda p: (-score[p], p), default=None)
    return best, score.get(best, 0.0)


def host_of(url_col: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def parsed(pages: DataFrame) -> DataFrame:
    """The rows of ``pages(id, url, host, html)`` without html but with

    * path, score: the page's own best container;
    * paths, shape: its container paths in order, and a key of them;
    * texts, inside: its blocks, and for each the places in paths of the
      containers that it is in.
    """
    schema = (pages.select("id", "url", "host").schema.add("path", T.StringType()).add("score", T.DoubleType())
              .add("shape", T.BinaryType()).add("paths", T.ArrayType(T.StringType()))
              .add("texts", T.ArrayType(T.StringType())).add("inside", T.ArrayType(T.ArrayType(T.IntegerType()))))
    arrow = to_arrow_schema(schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, PAGES):
                b = whole.slice(lo, PAGES)
                new: dict[str, list] = {name: [] for name in arrow.names[3:]}
                for h in b.column("html"):
                    found = list(blocks(h.as_py()))
                    path, score = _best(_scores(found))
                    paths = sorted({p for ps, _, _, _ in found for p in ps})
                    place = {p: k for k, p in enumerate(paths)}
                    new["path"].append(path)
                    new["score"].append(float(score))
                    # no path holds white space
                    new["shape"].append(xxhash.xxh3_128_digest("\n".join(paths).encode("utf-8", "replace")))
                    new["paths"].append(paths)
                    new["texts"].append([t for _, _, t, _ in found])
                    new["inside"].append([[place[p] for p in ps] for ps, _, _, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("url"), b.column("host"),
                     *(pa.array(new[name], arrow.field(name).type) for name in arrow.names[3:])], schema=arrow)

    return pages.mapInArrow(parse, schema)


def shape_paths(pages: DataFrame) -> DataFrame:
    """``(host, shape, path, n)`` from ``pages(host, path, score, shape,
    paths)``: for the n pages of a host with equal container paths, the one
    with most votes of the host, then most score.

    Nothing is gathered per host: votes, shapes and their paths are rows.  A
    path that is in most shapes of a large host is a hot key of that join.
    """
    seen = materialize(pages.groupBy("host", "shape", "paths", "path").agg(
        F.count("*").alias("votes"), F.sum("score").alias("score")), "page-shapes")
    votes = (seen.filter("path IS NOT NULL").groupBy("host", "path")
             .agg(F.sum("votes").alias("votes"), F.sum("score").alias("score")))
    shapes = seen.groupBy("host", "shape", "paths").agg(F.sum("votes").alias("n"))
    held = materialize(shapes.select("host", "shape", "n", F.explode_outer("paths").alias("path")), "shape-paths")
    # every path of a shape has a row, also those that nobody voted for
    rows = held.groupBy("host", "path").agg(F.count("*").alias("rows")).join(votes.hint("merge"), ["host", "path"], "left")
    rows = materialize(rows.filter("path IS NOT NULL"), "path-votes")
    total = rows.agg(F.sum("rows")).first()[0] or 0
    best = F.min(F.when(F.col("votes").isNotNull(), F.struct(-F.col("votes"), -F.col("score"), F.col("path").alias("path"))))
    return (join_dimension(held, rows, ["host", "path"], "rows", total).groupBy("host", "shape")
            .agg(best.alias("b"), F.first("n").alias("n")).select("host", "shape", F.col("b.path").alias("path"), "n"))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``(id_col, url_col, text, path)`` per page: the main text and the
    container path it came from, the one with most votes of its host among all
    that the page has.

    NULL or empty html gives an empty text and a NULL path; pages without a
    host vote together; repeated rows and ids stay as they are; other columns
    are ignored; an empty table gives an empty result.
    """
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host_of(url_col).alias("host"),
                       F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    read = materialize(parsed(src), "parsed-pages")
    chosen = materialize(shape_paths(read), "host-paths")
    total = chosen.agg(F.sum("n")).first()[0] or 0
    joined = join_dimension(read.drop("path", "score"), chosen, ["host", "shape"], "n", total)
    place = (F.array_position("paths", F.col("path")) - 1).cast("int")
    text = F.array_join(F.filter("texts", lambda t, k: F.array_contains(F.col("inside")[k], F.col("place"))), "\n")
    return (joined.withColumn("place", place)
            .select(F.col("id").alias(id_col), F.col("url").alias(url_col),
                    F.when(F.col("path").isNull(), "").otherwise(text).alias("text"), "path"))
