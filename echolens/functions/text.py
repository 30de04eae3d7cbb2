"""Text column builders, all JVM-side built-ins (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


# Unicode letters, digits and '_' (a word character as Python's str regex
# sees it), plus the characters Python's str regex counts as whitespace.
# Written out so Java and RE2-based engines agree on it.
_WS = r" \t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
SYMBOL_PATTERN = r"[^\p{L}\p{N}_" + _WS + ",]"


def keyword_col_name(kw: str) -> str:
    """'social distancing' -> 'social_distancing', 'sars-cov-2' -> 'sars_cov_2'."""
    return kw.replace(" ", "_").replace("-", "_")


def contains_keyword(text: str | Column, kw: str) -> Column:
    """Substring test on lower-cased text ('covid' also hits 'covidiot')."""
    return F.instr(F.lower(_c(text)), kw.lower()) > 0


def keyword_flags(df, text: str, keywords, as_int: bool = True):
    """One 0/1 (or boolean) column per keyword."""
    cols = []
    for kw in keywords:
        c = contains_keyword(text, kw)
        cols.append((c.cast("int") if as_int else c).alias(keyword_col_name(kw)))
    return df.select("*", *cols)


def any_keyword(text: str | Column, keywords) -> Column:
    """True when any keyword is a substring of the lower-cased text."""
    low = F.lower(_c(text))
    return F.exists(F.array(*[F.lit(k.lower()) for k in keywords]), lambda k: F.instr(low, k) > 0)


def is_link_only(text: str | Column) -> Column:
    """Exactly one space-separated token and it starts with 'http'."""
    t = _c(text)
    return (F.size(F.split(t, " ", -1)) == 1) & t.startswith("http")


def mask_handles_and_links(text: str | Column) -> Column:
    """'@x' (longer than 1 char) -> '@user', 'http...' -> 'http', on single-space tokens."""
    toks = F.split(_c(text), " ", -1)
    return F.array_join(F.transform(toks, lambda t: F.when(
        t.startswith("@") & (F.length(t) > 1), F.lit("@user")).when(
        t.startswith("http"), F.lit("http")).otherwise(t)), " ")


def symbol_count(text: str | Column) -> Column:
    """Number of characters that are neither word characters, whitespace nor ','."""
    return F.regexp_count(_c(text), F.lit(SYMBOL_PATTERN))


# HTML entities decoded in page titles, plus the title normalisation of the
# readability tool (dashes -> '-', no-break space -> ' ', guillemets -> '"').
HTML_ENTITIES = [
    ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"),
    ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&reg;", "®"),
    ("&mdash;", "-"), ("&ndash;", "-"), ("&hellip;", "…"), ("&rsquo;", "’"),
    ("&lsquo;", "‘"), ("&rdquo;", "”"), ("&ldquo;", "“"),
    ("&amp;", "&"),  # last, so '&amp;lt;' decodes once
]
TITLE_CHAR_MAP = [("\u2014", "-"), ("\u2013", "-"), ("\u00a0", " "), ("\u00ab", '"'), ("\u00bb", '"')]


def html_title(html: str | Column) -> Column:
    """Text of the first <title> element, entities decoded, spaces collapsed; '[no-title]' if absent."""
    raw = F.regexp_extract(_c(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return F.when(F.length(raw) == 0, F.lit("[no-title]")).otherwise(_plain(raw))


def _plain(raw: Column) -> Column:
    """Entities decoded, dashes and quotes plain, white space collapsed."""
    t = raw
    for ent, ch in HTML_ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    for a, b in TITLE_CHAR_MAP:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.regexp_replace(F.regexp_replace(t, "[" + _WS + "]+", " "), "^ | $", "")


# What stands between a headline and the name of its site, in order of preference.
TITLE_DELIMITERS = [" | ", " - ", " :: ", " / "]


def short_title(html: str | Column) -> Column:
    """The headline without the site's name.

    The longest heading (h1 to h3, two words and 15 characters or more) that
    the full title contains; else the title's first part before a delimiter,
    or its last part, whichever has four words; else what follows a colon.
    A result that isn't 16 to 149 characters long is the full title.
    """
    full = html_title(html)

    def words(c):
        return F.size(F.split(c, " "))

    def last(c, d):
        return F.element_at(F.split(c, _quoted(d)), -1)

    heads = F.transform(F.regexp_extract_all(_c(html), F.lit(r"(?is)<h[1-3][^>]*>(.*?)</h[1-3]>"), F.lit(1)),
                        lambda h: _plain(F.regexp_replace(h, "<[^>]*>", "")))
    inside = F.filter(heads, lambda h: (words(h) >= 2) & (F.length(h) >= 15)
                      & F.contains(F.replace(full, F.lit('"'), F.lit("")), F.replace(h, F.lit('"'), F.lit(""))))
    longest = F.array_max(F.transform(inside, lambda h: F.struct(F.length(h).alias("n"), h.alias("h"))))["h"]
    parts = []
    for d in TITLE_DELIMITERS:
        first = F.split(full, _quoted(d))[0]
        parts.append(F.when(F.contains(full, F.lit(d)), F.when(words(first) >= 4, first).when(words(last(full, d)) >= 4, last(full, d))))
    colon = F.when(F.contains(full, F.lit(": ")), F.when(words(last(full, ": ")) >= 4, last(full, ": ")).otherwise(
        F.element_at(F.split(full, ": ", 2), -1)))
    short = F.coalesce(longest, *parts, colon, full)
    return F.when((F.length(short) > 15) & (F.length(short) < 150), short).otherwise(full)


def _quoted(d: str) -> str:
    """``d`` as a pattern that matches itself."""
    return d.replace("|", "[|]")


def link_stem(url: str | Column, mode: str = "charset") -> Column:
    """Host stem of a profile link.

    ``charset`` strips the characters of 'https://', 'http://', 'www.' from
    both ends (what the published code does, e.g. 'sputnik.com' -> 'utnik');
    ``prefix`` removes the scheme and 'www.' as prefixes.  Then the text up to
    the first '.'.
    """
    u = _c(url)
    if mode == "charset":
        s = F.btrim(F.btrim(F.btrim(u, F.lit("https://")), F.lit("http://")), F.lit("www."))
    else:
        s = F.regexp_replace(u, r"^(https?://)?(www\.)?", "")
    return F.split(s, r"\.", -1).getItem(0)


def strip_quotes_blanks(c: str | Column) -> Column:
    """Remove double quotes and blanks."""
    return F.translate(_c(c), '" ', "")


def parse_dotted_int(c: str | Column) -> Column:
    """'1.234.567' -> 1234567."""
    return F.replace(_c(c), F.lit("."), F.lit("")).cast("long")


def mentions(text: str | Column) -> Column:
    """Handles mentioned in free text: '@' followed by word characters."""
    return F.regexp_extract_all(_c(text), F.lit(r"@(\w+)"), 1)


def id_query(ids: str | Column, prefix: str = "conversation_id:") -> Column:
    """Search string from an id array: prefix + ids joined by ' OR ' (ids in ascending order)."""
    return F.concat(F.lit(prefix), F.array_join(
        F.transform(F.array_sort(_c(ids)), lambda x: x.cast("string")), " OR "))


def keyword_query(keywords, since: str | None = None, until: str | None = None,
                  author: str | None = None) -> str:
    """Search text: ("k1" OR "k2") from:author since:.. until:.. (a driver-side string)."""
    q = "(" + " OR ".join('"' + k + '"' for k in keywords) + ")"
    if author:
        q += " from:" + author
    if since:
        q += " since:" + since
    if until:
        q += " until:" + until
    return q
