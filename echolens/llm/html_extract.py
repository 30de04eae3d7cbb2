"""Main text of HTML pages by template deduction over the pages of a host.

Tokens of a page are its tags, told apart by their path, and its text
segments outside the main part, told apart by path and text.  A token's
occurrence vector says how often it occurs on each page of the host; it is
kept as a sum of hashes of (page, count), which adds up on the map side, so
a host with a third of all pages is no large group.  Tokens with equal
vectors form an equivalence class; a class is valid if it has at least
``MIN_TOKENS`` tokens (a text of its own needs ``MIN_PAGES`` pages) and
covers at least half of the host's pages.  Classes nest by their paths: the
class that occurs once on every page is the root of the host's template,
others lie in its slots.  The host's content slot is its outermost article
or main path in a valid class, else the deepest valid path whose slots hold
most of the host's text.

A page's text are the text slots under its host's content path, without
template texts and without the parts that are not the article by their tag,
role or class (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, comments).  Outside the main part a word of the class or id
tells these; inside it only roles and whole class names do, as ids there are
mostly slugs of headings.  Inside an article element nothing is dropped
for being repeated.  A page without its host's content path falls back to
its own article or main element, else to its body.

Defined results: null or empty html gives an empty text; a null or odd url
is a host of its own (the empty one); very long pages are read whole;
repeated pages count each and get equal texts; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import write_table

MIN_TOKENS = 3
MIN_PAGES = 3
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""", re.S)
_ATTR = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
           "kbd", "mark", "q", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
_NOT_MAIN = {"nav", "footer", "aside", "form", "button", "select", "option", "svg", "menu", "dialog", "head", "object", "canvas",
             "audio", "video", *_RAW}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}
_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "nav", "navbar", "navigation",
          "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead", "banner", "cookie", "cookies", "consent", "gdpr",
          "notice", "popup", "modal", "newsletter", "subscribe", "signup", "comment", "comments", "disqus", "respond", "share", "sharing",
          "social", "related", "widget", "toolbar", "pagination", "pager", "copyright", "login", "search", "skip"}
# Whole class names that also tell them inside the main part.
_CLASSES = _WORDS | {
    "comments-area", "comment-list", "commentlist", "comment-respond", "comment-form", "comments-section", "disqus-thread", "share-buttons",
    "share-links", "share-bar", "sharedaddy", "social-share", "social-links", "social-icons", "related-posts", "related-articles", "related-links",
    "post-navigation", "posts-navigation", "nav-links", "navigation-links", "cookie-notice", "cookie-banner", "cookie-consent",
    "newsletter-signup", "newsletter-form", "ad-container", "ad-slot", "ad-unit", "ad-banner", "site-footer", "search-form", "login-form",
    "skip-link"}
_CLOSES_P = {"p", "div", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "aside", "nav", "header", "footer",
             "main", "form", "blockquote", "pre", "hr", "figure", "address"}
_SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                 "option": {"option"}}


def _hash(s: str) -> int:
    return xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass")) - (1 << 63)


class _Element:
    __slots__ = ("tag", "path", "main", "skip")

    def __init__(self, tag, path, main, skip):
        self.tag, self.path, self.main, self.skip = tag, path, main, skip


def _opened(tag: str, raw: str, parent: _Element) -> _Element:
    attrs = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTR.findall(raw)} if raw.strip(" /") else {}
    names = " ".join(attrs.get(k, "") for k in ("class", "id")).lower()
    role = attrs.get("role", "").lower()
    if parent.main:
        named = bool(_CLASSES & set(attrs.get("class", "").lower().split()))
    else:       # a page's own containers are never told by their names, an article not by its id
        told = "" if tag in ("html", "body", "main") else attrs.get("class", "").lower() if tag == "article" else names
        named = bool(_WORDS & set(re.split(r"[^a-z0-9]+", told)))
    skip = (parent.skip or tag in _NOT_MAIN or role in _ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true"
            or "display:none" in attrs.get("style", "").replace(" ", "").lower()
            or named
            or not parent.main and (tag == "header" or "header" in re.split(r"[^a-z0-9]+", names)))
    main = parent.main or not skip and (tag in ("article", "main") or role in ("main", "article"))
    return _Element(tag, f"{parent.path}/{tag}" + (f".{'.'.join(names.split())}" if names.strip() else ""), main, skip)


def events(page: str):
    """("open", element) for every element, ("text", element, raw text) for every stretch, ("break",) at block borders."""
    stack, at, n = [_Element("", "", False, False)], 0, len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        end = m.start() if m else n
        if end > at:
            yield "text", stack[-1], page[at:end]
        if not m:
            return
        at = m.end()
        closed, tag = (x.lower() if x else None for x in m.group(1, 2))
        if closed:
            if any(e.tag == closed for e in stack):
                while stack.pop().tag != closed:
                    pass
            if closed not in _INLINE:
                yield ("break",)
        elif tag:
            if tag in _CLOSES_P and any(e.tag == "p" for e in stack):
                while stack.pop().tag != "p":
                    pass
            while stack[-1].tag in _SELF_CLOSING.get(tag, ()):
                stack.pop()
            if tag not in _INLINE:
                yield ("break",)
            e = _opened(tag, m.group(3) or "", stack[-1])
            yield "open", e
            if tag in _RAW:
                m = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = m.end() if m else n
            elif tag == "br":
                yield "text", stack[-1], " "
            elif tag not in _VOID and not (m.group(3) or "").endswith("/"):
                stack.append(e)


def _tidy(parts: list[str]) -> str:
    return " ".join(entities.unescape("".join(parts)).split())


def page_tokens(page: str | None) -> tuple[dict, dict, dict]:
    """Tag paths -> count, (path, text) outside the main part -> count, path -> characters of text in its slots."""
    tags, texts, chars = {}, {}, {"": 0}
    main = set()
    for e in events(page or ""):
        if e[0] == "open":
            tags[e[1].path] = tags.get(e[1].path, 0) + 1
            if e[1].main:
                main.add(e[1].path)
        elif e[0] == "text" and not e[1].skip:
            t = _tidy([e[2]])
            if t:
                if not e[1].main:
                    texts[e[1].path, t] = texts.get((e[1].path, t), 0) + 1
                path = e[1].path
                while True:
                    chars[path] = chars.get(path, 0) + len(t)
                    if not path:
                        break
                    path = path[:path.rindex("/")]
    return tags, texts, {p: (c, p in main) for p, c in chars.items()}


def main_text(page: str | None, content: str | None, template: set) -> str:
    """Text of the slots under ``content`` (or the page's own article, or its body), blocks joined by two line ends."""
    inside, own, rest, part, where = [], [], [], [], None

    def flush():
        text = _tidy(part)
        if text and where is not None and not where.skip:
            if content and (where.path == content or where.path.startswith(content + "/")) and (
                    where.main or _hash(where.path + "\n" + text) not in template):
                inside.append(text)
            if where.main:
                own.append(text)
            elif _hash(where.path + "\n" + text) not in template:
                rest.append(text)
        part.clear()

    for e in events(page or ""):
        if e[0] == "break":
            flush()
            where = None
        elif e[0] == "text" and not e[1].skip:
            if where is None or not where.path:
                where = e[1]
            part.append(e[2])
    flush()
    return "\n\n".join(inside or own or rest)


def deduce(pages: DataFrame) -> DataFrame:
    """Per host: its content path and the hashes of its template texts."""
    def run(batches):
        for b in batches:
            rows = []
            for host, page_id, page in zip(b["host"], b["page"], b["html"]):
                tags, texts, chars = page_tokens(page)
                for path, n in tags.items():
                    c, main = chars.get(path, (0, False))
                    rows.append((host, path, 0, _hash(f"{page_id} {n}"), n, c, main))
                rows.append((host, "", 0, _hash(f"{page_id} 1"), 1, chars[""][0], False))
                for (path, t), n in texts.items():
                    rows.append((host, path, _hash(path + "\n" + t), _hash(f"{page_id} {n}"), n, 0, False))
            yield pd.DataFrame(rows, columns=["host", "path", "text", "mark", "n", "chars", "main"])

    tokens = pages.mapInPandas(run, "host string, path string, text long, mark long, n int, chars long, main boolean")
    # Marks are kept below 2**40 so that sums of them stay within a long; two classes share a sum with odds of 2**-40.
    tokens = tokens.groupBy("host", "path", "text").agg(
        F.sum(F.pmod(F.xxhash64("mark"), F.lit(1 << 40))).alias("vector"), F.count(F.lit(1)).alias("pages"),
        F.max("n").alias("most"), F.sum("chars").alias("chars"), F.max("main").alias("main"))
    tokens = write_table(tokens, "tokens")
    hosts = tokens.filter("path = '' AND text = 0").select("host", F.col("pages").alias("of"), F.col("chars").alias("host_chars"))
    classes = tokens.groupBy("host", "vector", "pages").agg(F.count(F.lit(1)).alias("members"))
    valid = tokens.join(classes.filter(F.col("members") >= MIN_TOKENS), ["host", "vector", "pages"]).join(hosts, "host").filter(
        2 * F.col("pages") >= F.col("of"))
    depth = F.size(F.split("path", "/"))
    slots = valid.filter("text = 0 AND path <> '' AND (main OR 2 * chars >= host_chars)")
    content = slots.groupBy("host").agg(F.max(F.struct("main", F.when(F.col("main"), F.col("chars")).otherwise(0).alias("c"),
                                                       F.when(F.col("main"), -depth).otherwise(depth).alias("d"), "path")).alias("best"))
    # At most twice a page's texts reach half of a host's pages.
    repeated = tokens.filter(f"text <> 0 AND pages >= {MIN_PAGES}").join(hosts, "host").filter(2 * F.col("pages") >= F.col("of")) \
        .groupBy("host").agg(F.collect_set("text").alias("texts"))
    return hosts.select("host").join(content, "host", "left").join(repeated, "host", "left").select(
        "host", F.col("best.path").alias("content"), F.coalesce("texts", F.array().cast("array<bigint>")).alias("texts"))


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars."""
    host = F.coalesce(F.lower(F.regexp_extract("url", HOST, 1)), F.lit(""))
    d = pages.select("page_id", "url", "html", host.alias("host"), F.xxhash64("page_id", "url", "html").alias("page"))
    templates = write_table(deduce(d.select("host", "page", "html")), "templates")

    @F.pandas_udf("string")
    def run(html: pd.Series, content: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, c, set(() if t is None else np.asarray(t).tolist())) for h, c, t in zip(html, content, texts)],
                         dtype=object)

    out = d.join(templates, "host", "left").select("page_id", "url", run("html", "content", "texts").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def query(spark, sf_dir):
    from .base import table
    return extract(table(spark, sf_dir, "pages"))
