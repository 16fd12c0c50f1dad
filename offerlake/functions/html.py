"""Accessors for the page anchors the listing extractors use.

These cover the cited anchors only (a tag picked by one attribute value, its
text runs or another attribute), not HTML in general.  All are Spark column
expressions (JVM regex and array functions), evaluated row by row inside the
scan's stage; the array functions run outside generated code.  Tag and
attribute names match in any case, values as they are written.  A missing
anchor gives NULL (an empty match is turned into NULL).
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerlake.functions.parse import ColumnOrName, _c

# Script/style bodies and comments may hold text that looks like markup.
# (One '<' before the alternatives, and a look at the next character: most places and tags are then left at once.)
_HIDDEN = r"(?is)<(?=[s!])(?:script\b[^>]*>.*?</script>|style\b[^>]*>.*?</style>|!--.*?-->)"

# FIXED VALUES: the character references decoded in extracted text
# ('&amp;' last, so '&amp;lt;' becomes '&lt;' and not '<').
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _lit(s: str) -> Column:
    return F.lit(s)


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f(c)`` with ``c`` made once, however often ``f`` reads it: a lambda variable holds a value, where
    Spark makes an expression again for each branch that reads it."""
    return F.transform(F.array(c), f)[0]


def decoded(x: Column) -> Column:
    """``unescape`` of a value that costs nothing to read again."""
    out = x
    for ent, ch in ENTITIES:
        out = F.replace(out, _lit(ent), _lit(ch))
    return F.when(x.contains("&"), out).otherwise(x)


def unescape(c: ColumnOrName) -> Column:
    """Decode the common character references of extracted text."""
    return once(_c(c), decoded)


def text_or_null(c: Column) -> Column:
    """Extracted text, decoded; NULL where it is empty."""
    return once(c, lambda x: F.when(x != "", decoded(x)))


def visible(html: ColumnOrName) -> Column:
    """The page without script and style bodies and comments."""
    return F.regexp_replace(_c(html), _HIDDEN, "")


#: What ``\s`` matches, spelled out: a class of plain characters is the fastest.
SPACE = r" \t\n\x0B\f\r"


def any_case(name: str) -> str:
    """Pattern of a tag's or attribute's name in any case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else re.escape(c) for c in name)


def first_in_tag(start: str, stop: str | None = None) -> str:
    """Pattern of a start tag's inside up to and with the first ``\\s`` + ``start``; no match where the first
    ``\\s`` + ``stop`` is none.

    Only white space may be followed by it, so the rest is passed over in runs that
    are not tried again character by character (the loop is possessive: its depth is bounded).
    """
    return rf"[^>{SPACE}]*+(?:\s(?!{stop or start})[^>{SPACE}]*)*+\s{start}"


def _attr_sel(attr: str, value: str) -> str:
    """This attribute with this value in matching quotes."""
    v = re.escape(value)
    return rf"""{any_case(attr)}\s*=\s*(?:"{v}"|'{v}')"""


def open_tag(tag: str, attr: str | None = None, value: str | None = None) -> str:
    """Pattern of a start tag, from '<' to '>'; the attribute has this very name (white space before it)."""
    sel = first_in_tag(_attr_sel(attr, value)) if attr else ""
    return rf"<{any_case(tag)}(?=[\s>/]){sel}[^>]*>"


def attribute_value(tag_text: Column, attr: str) -> Column:
    """Value of an attribute of a start tag, decoded; '' if the attribute is empty, NULL if it is missing."""
    pat = rf"""(?s)\s{any_case(attr)}\s*=\s*(["'])(.*?)\1"""
    return unescape(F.get(F.regexp_extract_all(tag_text, F.lit(pat), 2), 0))


def inner(rest: Column, tag: str) -> Column:
    """Inner markup of an element whose start tag ends where ``rest`` begins: up to its own end tag.

    ``rest`` is cut before every start and end tag of this name; the running
    depth of the pieces tells where the element closes.  Unclosed, it takes all.
    """
    name = any_case(tag)
    pieces = F.split(rest, rf"(?=<(?:{name}[\s>/]|/{name}\s*>))")

    def step(acc: Column, x: Column) -> Column:
        depth = acc["depth"] + F.when(x.rlike(rf"^</{name}\s*>"), -1).when(x.rlike(rf"^<{name}[\s>/]"), 1).otherwise(0)
        depth = F.when(acc["depth"] == 0, 0).otherwise(depth)
        return F.struct(depth.alias("depth"), (acc["n"] + F.when(depth > 0, 1).otherwise(0)).alias("n"))

    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n"))
    # A lambda variable holds the pieces, so they are cut once.
    return once(pieces, lambda p: F.array_join(F.slice(p, 1, F.aggregate(p, start, step)["n"]), ""))


def from_first(html: Column, value: str) -> Column:
    """The page from just after the last '>' before the first ``value`` on; NULL without one.

    A start tag that holds ``value`` (which has no '>') cannot begin before that, and a search for
    plain text is many times as fast as one for a tag.
    """
    cut = F.split(html, re.escape(value), 2)
    return once(cut, lambda x: F.when(F.size(x) == 2, F.concat(F.substring_index(x[0], ">", -1), F.lit(value), x[1])))


def element_inner(html: ColumnOrName, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    """Inner markup of the first ``<tag attr="value">``, nested elements of its name included; NULL if absent."""
    start = open_tag(tag, attr, value)
    # From the start tag's '>' on, '' without one: the page is searched once, and made once where it is an expression.
    page = from_first(_c(html), value) if value and ">" not in value else _c(html)
    found = F.regexp_extract(page, rf"(?s){start.removesuffix('>')}(>.*)$", 1)
    return once(found, lambda x: F.when(x != "", inner(F.substring(x, 2, 2**31 - 1), tag)))


def all_inner(html: ColumnOrName, tag: str) -> Column:
    """Inner markup of every ``<tag>`` element of a kind that does not nest."""
    return F.regexp_extract_all(_c(html), F.lit(rf"(?s){open_tag(tag)}(.*?)</{any_case(tag)}\s*>"), 1)


def direct_text(html: ColumnOrName, tag: str, attr: str, value: str) -> Column:
    """First text node right inside ``<tag attr="value">`` (xpath ``tag[@attr=value]/text()``); NULL if none."""
    pat = rf"(?s){open_tag(tag, attr, value)}([^<]*)"
    return text_or_null(F.regexp_extract(_c(html), pat, 1))


def tag_attribute(html: ColumnOrName, tag: str, attr: str, value: str, wanted: str) -> Column:
    """Attribute ``wanted`` of the first ``<tag attr="value">`` (xpath ``//tag[@attr=value]/@wanted``)."""
    found = F.regexp_extract(_c(html), rf"({open_tag(tag, attr, value)})", 1)
    return once(found, lambda x: F.when(x != "", attribute_value(x, wanted)))


def text_runs(fragment: Column) -> Column:
    """Text nodes of a fragment of markup, in order, without empty ones; not decoded."""
    return F.filter(F.split(fragment, r"<[^>]*>"), lambda x: x != "")


def first_text(fragments: Column) -> Column:
    """TakeFirst over the text nodes of several fragments: the first non-empty one, decoded."""
    return unescape(F.get(F.flatten(F.transform(fragments, text_runs)), 0))


def script_body(html: ColumnOrName, script_id: str) -> Column:
    """Text of ``<script id="...">``; NULL when the page has none."""
    tag = open_tag("script", "id", script_id)
    body = F.regexp_extract(_c(html), rf"(?s){tag}(.*?)</{any_case('script')}\s*>", 1)
    # Only an empty body may mean that there is no such tag.
    return once(body, lambda x: F.when((x != "") | _c(html).rlike(tag), x))


def json_document(text: Column) -> Column:
    """A JSON text with what is read from it: (doc, v), v its VARIANT, parsed once for all fields.

    NULL where a VARIANT cannot hold the text (a key that occurs twice, say); ``json_text`` reads the text then.
    """
    return once(text, lambda t: F.struct(t.alias("doc"), F.try_parse_json(t).alias("v")))


def json_text(document: Column, path: str) -> Column:
    """The value at a path of a ``json_document`` as text; NULL if missing or null."""
    return F.when(document["v"].isNotNull(), F.try_variant_get(document["v"], path, "string")).otherwise(
        F.get_json_object(document["doc"], path)
    )
