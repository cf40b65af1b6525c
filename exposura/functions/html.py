"""Extraction from stored pages.

One grammar of markup serves all: comments, raw text elements, declarations and tags
are told apart once, and selectors, cards and visible text are read off its tokens.
"""

from __future__ import annotations

import json
import re
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from exposura.functions.text import abs_url, bind, strip

# Named entities whose replacement is not their own character: a blank that folds with others.
AS_BLANK = {"nbsp": " "}
NAMED = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"} | AS_BLANK
ENTITY = r"&(?:#[0-9]{1,9}|#[xX][0-9A-Fa-f]{1,8}|[A-Za-z][A-Za-z0-9]{1,8});"
ANCHOR = r"(?is)<a\s[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>"


def _decoded(entity: Column) -> Column:
    """The character of one entity; an unknown name stays, a number of no character becomes U+FFFD."""
    body = F.substring(entity, 2, F.length(entity) - 2)
    hexadecimal = F.lower(F.substring(body, 2, 1)) == "x"
    code = F.when(hexadecimal, F.conv(F.substr(body, F.lit(3)), 16, 10)).otherwise(F.substr(body, F.lit(2))).cast("long")
    drawn = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(F.when(drawn, code).otherwise(0xFFFD)), 8, "0")), "UTF-32")
    names = F.from_json(F.lit(json.dumps(NAMED)), "map<string,string>")
    return F.when(body.startswith("#"), char).otherwise(F.coalesce(F.try_element_at(names, body), entity))


def decode_entities(c: Column) -> Column:
    """Named and numbered character references to characters, each once."""
    def decoded(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(ENTITY), F.lit(0)), _decoded)
        between = F.split(t, ENTITY, -1)
        return F.array_join(F.flatten(F.zip_with(
            between, found, lambda x, y: F.array(x, F.coalesce(y, F.lit(""))))), "")

    return bind(c, lambda t: F.when(t.contains("&"), decoded(t)).otherwise(t))


# Markup: comments, elements of raw text with what they hold, declarations, tags. A quote
# counts only where an attribute's value begins.
SILENT = r"(?is)<!--(?:-?>|.*?(?:-->|$))|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|$)"
MARKUP = SILENT + r"""|<[!?][^>]*>|</?[a-z](?:[^>=]|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+>"""
TAG = r"(?i)^</?([a-z][^\s/>]*)"


def strip_html(c: Column) -> Column:
    """Visible text: scripts, styles, comments and tags out, entities decoded."""
    return strip(F.regexp_replace(decode_entities(F.regexp_replace(c, MARKUP, " ")), r"\s+", " "))


def tokens(c: Column) -> Column:
    """The page's tags, comments, raw elements and runs of text, in order; joined they are the page."""
    return F.regexp_extract_all(c, F.lit(MARKUP + "|[^<]+|<"), F.lit(0))


def opens(token: Column, selector: str) -> Column:
    """Whether a token is an opening tag under a selector.

    A selector is `tag`, `tag.class` or `tag[attribute*=part]`, or several of them
    with commas between.
    """
    def value(attribute: str, inner: str, bare: str) -> str:
        return rf"""\s{attribute}\s*=\s*(?:"{inner.replace('@', '[^"]*')}"|'{inner.replace('@', "[^']*")}'|{bare})"""

    out = F.lit(False)
    for one in selector.split(","):
        tag, css, attribute, part = re.fullmatch(r"\s*([\w-]+)(?:\.([\w-]+))?(?:\[([\w-]+)\*=['\"]?([^'\"\]]*)['\"]?\])?\s*", one).groups()
        test = token.rlike(rf"(?i)^<{tag}(?=[\s/>])")
        if css:
            word = re.escape(css)
            test = test & token.rlike("(?i)" + value("class", rf"(?:@\s)?{word}(?:\s@)?", rf"{word}(?=[\s>])"))
        if attribute:
            piece = re.escape(part)
            test = test & token.rlike("(?i)" + value(attribute, f"@{piece}@", rf"(?![\"'])[^\s>]*{piece}"))
        out = out | test
    return out


def _spans(found: Column, selector: str, first: bool) -> Column:
    """(begin, end) of the outermost elements under a selector, as places among the tokens.

    A fold that counts the open elements of the same tag; an element that is never
    closed runs to the page's end, and its span has end 0.
    """
    span = "array<struct<begin:int,end:int>>"
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("tag"), F.lit(0).alias("depth"), F.array().cast(span).alias("out"))

    def step(at: Column, token: Column) -> Column:
        i = at["i"] + 1
        name = F.lower(F.regexp_extract(token, TAG, 1))
        idle, same = at["depth"] == 0, (at["tag"] == name) & (name != "")
        begins = idle & token.startswith("<") & opens(token, selector)
        if first:
            begins = begins & (F.size(at["out"]) == 0)
        ends = ~idle & same & token.startswith("</") & (at["depth"] == 1)
        depth = F.when(begins, 1).when(idle | ~same, at["depth"]).when(token.startswith("</"), at["depth"] - 1).otherwise(at["depth"] + 1)
        opened = F.array(F.struct(i.alias("begin"), F.lit(0).alias("end"))).cast(span)
        last = F.size(at["out"])
        closed = F.concat(F.slice(at["out"], F.lit(1), last - 1), F.array(
            F.struct(F.get(at["out"], last - 1)["begin"].alias("begin"), i.alias("end"))).cast(span))
        out = F.when(begins, F.concat(at["out"], opened)).when(ends, closed).otherwise(at["out"])
        return F.struct(i.alias("i"), F.when(begins, name).otherwise(at["tag"]).alias("tag"), depth.alias("depth"), out.alias("out"))

    return F.aggregate(found, start, step, lambda at: at["out"])


def _inner(found: Column, span: Column) -> Column:
    end = F.when(span["end"] > 0, span["end"]).otherwise(F.size(found) + 1)
    return F.array_join(F.slice(found, span["begin"] + 1, end - span["begin"] - 1), "")


def element_html(c: Column, selector: str) -> Column:
    """Inner HTML of the first element under a selector, "" if none.

    Elements of the same tag within it are counted, so the end is its own closing
    tag; an element that is never closed runs to the end of the page. Tags in
    comments and scripts are no tags.
    """
    def first(found: Column) -> Column:
        return bind(_spans(found, selector, True), lambda s: F.when(F.size(s) > 0, _inner(found, F.get(s, F.lit(0)))))

    names = "|".join(sorted({re.match(r"\s*([\w-]+)", s)[1] for s in selector.split(",")}))
    whole = bind(c, lambda page: F.when(page.rlike(rf"(?i)<(?:{names})[\s/>]"), bind(tokens(page), first)))
    return F.coalesce(whole, F.lit(""))


def elements_html(c: Column, selector: str) -> Column:
    """Inner HTML of every outermost element under a selector, in order."""
    return bind(tokens(c), lambda found: F.transform(_spans(found, selector, False), lambda s: _inner(found, s)))


def element_text(c: Column, selector: str) -> Column:
    return strip_html(element_html(c, selector))


def attribute(c: Column, selector: str, name: str) -> Column:
    """Attribute of the first opening tag under a selector, "" if there is none."""
    tag = F.get(F.filter(tokens(c), lambda t: t.startswith("<") & opens(t, selector)), F.lit(0))
    value = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|((?!["'])[^\s>]+))"""
    return F.coalesce(decode_entities(F.concat(*[F.regexp_extract(tag, value, k) for k in (1, 2, 3)])), F.lit(""))


def first_matching_selector(c: Column, selectors: list[str]) -> Column:
    """Text under the first selector that yields any, else ""."""
    hits = [bind(element_text(c, s), lambda t: F.when(t != "", t)) for s in selectors]
    return F.coalesce(*hits, F.lit(""))


def hrefs(c: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(c, SILENT, ""), F.lit(ANCHOR), F.lit(1))


def links(c: Column, root: Column) -> Column:
    """Absolute addresses in order of first appearance."""
    return F.array_distinct(F.transform(hrefs(c), lambda h: abs_url(h, root)))


def anchors(c: Column) -> Column:
    """(href, label) of every link."""
    labels = F.transform(F.regexp_extract_all(F.regexp_replace(c, SILENT, ""), F.lit(ANCHOR), F.lit(2)), strip_html)
    return F.zip_with(hrefs(c), labels, lambda h, t: F.struct(h.alias("href"), t.alias("label")))


def next_page_link(c: Column, page_pattern: str, next_pattern: str = r"(?i)next|^[»›]$") -> Column:
    """The link labelled next, else the last page link."""
    paged = F.filter(anchors(c), lambda a: a["href"].rlike(page_pattern))
    labelled = F.filter(paged, lambda a: a["label"].rlike(next_pattern))
    return F.coalesce(F.get(labelled, F.lit(0))["href"], F.try_element_at(paged, F.lit(-1))["href"])


def entries(c: Column, layout: dict[str, str]) -> Column:
    """(title, url, body) of every card of a page layout.

    A layout gives selectors: `card`, and within a card `title`, `link` and `text`;
    the first element under each counts. Without `text` the body is all of the card's
    text. A card ends at its own closing tag, whatever it holds.
    """
    def entry(card: Column) -> Column:
        body = element_text(card, layout["text"]) if "text" in layout else strip_html(card)
        return F.struct(
            element_text(card, layout["title"]).alias("title"), attribute(card, layout["link"], "href").alias("url"), body.alias("body"))

    return F.transform(elements_html(c, layout["card"]), entry)
