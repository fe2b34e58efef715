"""Main text of web pages by site style trees.

Pages of a host are merged into one tree: a node is a path of tags with their classes, and holds how often it is
presented with which children and how often which text stands below it. A node whose text and presentation are alike
on all pages has low entropy and is unimportant (menus, footers, notices); such branches are removed from each page. What
names itself a menu, form, advert or comment, by tag, role or class, has no importance. An article or main
element is presumed important: of it only texts are removed that stand on nearly all articles of the site (equal articles
count once), and what lies beside it goes, unless more important text lies beside it than in it, as with a teaser.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_slice, slices, stored

#: Element kinds of HTML, and names that sites give to what is not the article.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
             " span strike strong sub sup time tt u var wbr".split())
RAW = set("script style noscript template title textarea iframe svg math object".split())
ENDS_P = re.compile(r"address|article|aside|blockquote|details|div|dl|fieldset|figcaption|figure|footer|form|h[1-6]"
                    r"|header|hr|main|menu|nav|ol|p|pre|section|table|ul")
NOISE_TAGS = set("nav footer aside form button select head dialog menu".split())
NOISE_NAMES = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu nav navbar"
                  " navigation breadcrumb breadcrumbs header footer masthead topbar cookie cookies consent gdpr notice alert popup"
                  " modal overlay newsletter subscribe signup login search comment comments respond disqus share sharing"
                  " social related recommended widget toolbar pagination pager".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: A class that starts with one of these says what an element has or lacks, not what it is.
MODIFIERS = set("has with without no not hide show".split())
ARTICLE = {"article", "main"}
#: Opening one of these closes an open one of the others, up to their list or table.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}),
            "option": ({"option"}, {"select"})}
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
MIN_PAGES = 4
IMPORTANT = 0.2
GAMMA = 0.9
#: A text of an article is unimportant where this share of a site's articles has it at the same place, ...
REPEATED = 0.9
#: ... if the site has as many different articles at least; with fewer, near copies of one article would look like a frame.
MIN_ARTICLES = 10
FLUSH = 1 << 17


class Block:
    """A run of text between two block boundaries, with the style path it stands under."""

    __slots__ = ("in_article", "noise", "path", "text")

    def __init__(self, path: str, text: str, noise: bool, in_article: bool) -> None:
        self.path, self.text, self.noise, self.in_article = path, text, noise, in_article


def _style(tag: str, attributes: str, in_article: bool) -> tuple[str, bool]:
    """Name of a node in the style tree, and whether it names itself as something else than the article."""
    noise = tag in NOISE_TAGS or tag in RAW or (tag == "header" and not in_article)
    name = tag
    if attributes.strip(" /"):
        for key, *values in ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values).lower()
            if key in ("class", "id"):
                name += ("." if key == "class" else "#") + "_".join(value.split())
                noise |= tag not in ARTICLE and tag not in ("html", "body") and any(
                    parts[0] not in MODIFIERS and not NOISE_NAMES.isdisjoint(parts)
                    for parts in (re.split(r"[^a-z]+", one) for one in value.split()))
            elif key == "role":
                noise |= value.strip() in NOISE_ROLES
            elif key == "hidden":
                noise = True
    return name, noise


def blocks(page: str | None) -> tuple[list[Block], dict[str, list[str]]]:
    """Blocks of a page in order, and the names of the block children under each path."""
    page = page or ""
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # tag, path, noise, in article
    found: list[Block] = []
    children: dict[str, list[str]] = {}
    text: list[str] = []

    def flush() -> None:
        if text:
            words = " ".join(html.unescape("".join(text)).split())
            if words:
                top = next(x for x in reversed(stack) if x[0] not in INLINE)
                found.append(Block(top[1], words, stack[-1][2], stack[-1][3]))
            text.clear()

    def close(tags: set[str], barrier: set[str]) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in tags:
                flush()
                del stack[depth:]
                return
            if stack[depth][0] in barrier:
                return

    position = 0
    while True:
        match = MARKUP.search(page, position)
        if match is None:
            text.append(page[position:])
            break
        if match.start() > position:
            text.append(page[position:match.start()])
        position = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if match[1]:
            if tag in INLINE:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        if stack[depth][2] != stack[depth - 1][2]:
                            flush()
                        del stack[depth]
                        break
                    if stack[depth][0] not in INLINE:
                        break
            else:
                flush()
                close({tag}, set() if tag in ("body", "html", "article", "main") else {"article", "main"} - {tag})
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(page, position)
            if tag in ("iframe", "object"):
                flush()
            position = end.end()  # type: ignore[union-attr]
            continue
        if tag == "br":
            text.append("\n")
            continue
        if tag not in INLINE:
            flush()
            if ENDS_P.fullmatch(tag):
                close({"p"}, {"button", "td", "th", "table"})
            if tag in SIBLINGS:
                close(*SIBLINGS[tag])
            if tag == "body":
                close({"head"}, set())
        _, path, noise, in_article = stack[-1]
        name, own = _style(tag, match[3] or "", in_article)
        if own and not noise and tag in INLINE:
            flush()
        below = path if tag in INLINE and not own else f"{path}>{name}"
        if tag not in INLINE:
            children.setdefault(path, []).append(name)
        if tag not in VOID:
            stack.append((tag, below, noise or own, in_article or tag in ARTICLE))
    flush()
    return found, children


def digest(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode()) >> 1


def article_text(found: list[Block]) -> list[Block]:
    return [b for b in found if b.in_article and not b.noise]


def main_text(page: str | None, low: set[str]) -> str:
    """Text of the blocks left when branches and texts of low importance, and what lies beside an article, are removed.

    ``low``: paths of nodes, and path, NUL and digest of repeated texts of articles.
    """
    found = blocks(page)[0]
    nodes = tuple(p for p in low if "\0" not in p)
    article = [b for b in article_text(found) if len(nodes) == len(low) or f"{b.path}\0{digest(b.text)}" not in low]
    beside = [b for b in found if not b.noise and not b.in_article and not any(
        b.path == p or b.path.startswith(p + ">") for p in nodes)]
    if not article or sum(len(b.text) for b in beside) > sum(len(b.text) for b in article):
        chosen = {id(b) for b in (*article, *beside)}
        article = [b for b in found if id(b) in chosen]
    return "\n".join(b.text for b in article)


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))


def features(pages: DataFrame) -> DataFrame:
    """(host, path, kind, value, article, n, children): what the pages of each host show at each node, counted.

    kind 0: the children of a node, 1: its text, 2: a text of an article, by the digest of the whole article (with the
    path "" for the article itself).
    """
    schema = pa.schema([("host", pa.string()), ("path", pa.string()), ("kind", pa.int32()), ("value", pa.int64()),
                        ("article", pa.int64()), ("n", pa.int64()), ("children", pa.int64())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[tuple[str, str, int, int, int, int]] = Counter()

        def flush() -> pa.RecordBatch:
            rows = list(zip(*held)) if held else [[]] * 6
            out = pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int32()),
                 pa.array(rows[3], pa.int64()), pa.array(rows[5], pa.int64()), pa.array(list(held.values()), pa.int64()),
                 pa.array(rows[4], pa.int64())], schema=schema)
            held.clear()
            return out

        for part in slices(batches, "html"):
            rows = part.to_pydict()
            for site, page in zip(rows["host"], rows["html"]):
                found, children = blocks(page)
                for path, names in children.items():
                    held[site, path, 0, digest(">".join(names)), len(names), 0] += 1
                texts: dict[str, list[str]] = {}
                for block in found:
                    texts.setdefault(block.path, []).append(block.text)
                for path, parts in texts.items():
                    held[site, path, 1, digest(" ".join(parts)), 0, 0] += 1
                article = article_text(found)
                if article:
                    whole = digest("\n".join(b.text for b in article))
                    held[site, "", 2, whole, 0, whole] += 1
                    for path, text in {(b.path, b.text) for b in article}:
                        held[site, path, 2, digest(text), 0, whole] += 1
            if len(held) > FLUSH:
                yield flush()
        yield flush()

    rows = pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(
        count, "host string, path string, kind int, value long, article long, n long, children long")
    return rows.groupBy("host", "path", "kind", "value", "article").agg(
        F.sum("n").alias("n"), F.max("children").alias("children"))


def repeated_texts(features: DataFrame, share: float = REPEATED, min_articles: int = MIN_ARTICLES) -> DataFrame:
    """(host, path, value) of texts that stand at the same place in at least ``share`` of the different articles of a host."""
    seen = features.where("kind = 2").groupBy("host", "path", "value").count()
    sites = features.where("kind = 2 and path = ''").groupBy("host").agg(F.count(F.lit(1)).alias("articles"))
    return seen.where("path <> ''").where(F.col("count") >= share * min_articles).join(
        sites.where(F.col("articles") >= min_articles), "host").where(
            F.col("count") >= share * F.col("articles")).select("host", "path", "value")


def style_tree(features: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, path, pages, importance) of the nodes of each host's merged tree.

    importance = (1 - g^l) * presentation + g^l * content, with l children on average: entropies of the ways the node is
    presented, and of the texts of its leaves, as shares of the highest possible; 1 where fewer than ``min_pages``
    pages have the node.
    """
    nodes = features.where("kind < 2").groupBy("host", "path", "kind").agg(
        F.sum("n").alias("m"), F.sum(F.col("n") * F.log("n")).alias("nlogn"),
        (F.sum(F.col("n") * F.col("children")) / F.sum("n")).alias("l"))
    entropy = F.when(F.col("m") < min_pages, 1.0).otherwise(
        (F.log("m") - F.col("nlogn") / F.col("m")) / F.log("m"))
    nodes = stored(nodes.select("host", "path", "kind", "m", "l", entropy.alias("h")), "page-nodes")
    # a leaf's content counts for every node above it
    steps = F.split("path", ">")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), ">"))
    content = nodes.where("kind = 1").select("host", F.explode(above).alias("path"), "m", "h").groupBy("host", "path").agg(
        (F.sum(F.col("m") * F.col("h")) / F.sum("m")).alias("content"), F.max("m").alias("pages"))
    shown = nodes.where("kind = 0").select("host", "path", "l", F.col("h").alias("shown"))
    joined = content.join(shown, ["host", "path"], "left")
    share = F.pow(F.lit(GAMMA), F.coalesce("l", F.lit(0.0)))
    return joined.select("host", "path", "pages", (
        (1 - share) * F.coalesce("shown", F.lit(0.0)) + share * F.col("content")).alias("importance"))


def main_texts(pages: DataFrame, min_pages: int = MIN_PAGES, important: float = IMPORTANT) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html, anything else).

    Null and empty pages give an empty text; pages without a host are one site. Repeated rows count each. Other columns are
    left out.
    """
    shown = stored(features(pages), "page-features")
    low = style_tree(shown, min_pages).where((F.col("importance") < important) & (F.col("path") != "")).select("host", "path")
    texts = repeated_texts(shown).select("host", F.concat("path", F.lit("\0"), F.col("value").cast("string")).alias("path"))
    # style paths and shared texts of one site, not pages
    low = low.union(texts).groupBy("host").agg(F.collect_set("path").alias("low"))
    low = stored(low, "page-low").withColumnRenamed("host", "site")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    rows = rows.join(low, host(F.col("url")) == F.col("site"), "left")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(part: dict[str, list]) -> dict[str, list]:
        return {"page_id": part["page_id"], "url": part["url"],
                "text": [main_text(page, set(low or ())) for page, low in zip(part["html"], part["low"])]}

    return rows.select("page_id", "url", "html", "low").mapInArrow(
        per_slice(run, schema, "html"), "page_id long, url string, text string")

