"""Page extraction (survey 2.12) over the stored pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from exposura import rules
from exposura.catalog import views as v
from exposura.catalog.base import case_first, q, query, sql_in, strip, sub
from exposura.functions import html, text
from exposura.plans import jobs
from exposura.sources.readers import table


# The entities that the stored pages hold, ampersand last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def _decoded(x: str) -> str:
    for name, char in ENTITIES:
        x = f"replace({x}, {q(name)}, {q(char)})"
    return x


def _visible(x: str) -> str:
    x = f"regexp_replace({x}, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g')"
    x = f"regexp_replace({x}, '(?s)<[^>]*>', ' ', 'g')"
    x = f"regexp_replace({_decoded(x)}, '\\s+', ' ', 'g')"
    return strip(x)


def _pages(spark, folder):
    return table(spark, folder, "pages")


@query("extract_title_text", f"""
SELECT page_id, {_visible("regexp_extract(html, '(?is)<title(?:\\s[^>]*)?>(.*?)</title>', 1)")} AS title,
       {_visible("regexp_extract(html, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1>', 1)")} AS heading FROM pages""")
def extract_title_text(spark, folder):
    h = F.col("html")
    return _pages(spark, folder).select(
        "page_id", html.element_text(h, "title").alias("title"), html.element_text(h, "h1").alias("heading")
    )


LINKS = f"""links AS (
  SELECT page_id, unnest(range(len(a))) AS i, regexp_extract(url, '^([a-zA-Z]+://[^/?#]+)', 1) AS root, unnest(a) AS href FROM (
    SELECT page_id, url, regexp_extract_all(html, {q(html.ANCHOR)}, 1) AS a FROM pages))"""


@query("extract_links", f"""
WITH {LINKS}, full_links AS (SELECT page_id, i, CASE WHEN starts_with(href, 'http') THEN href ELSE root || '/' || ltrim(href, '/') END AS link FROM links),
firsts AS (SELECT page_id, link, min(i) AS i FROM full_links GROUP BY page_id, link)
SELECT page_id, count(*) AS n_links, md5(string_agg(link, ' ' ORDER BY i)) AS links_hash FROM firsts GROUP BY page_id""")
def extract_links(spark, folder):
    found = html.links(F.col("html"), text.root_url(F.col("url")))
    return _pages(spark, folder).select("page_id", found.alias("a")).select(
        "page_id", F.size("a").cast("long").alias("n_links"), F.md5(F.array_join("a", " ")).alias("links_hash")
    )


@query("first_matching_selector", f"""
SELECT page_id, length(t) AS n_chars, md5(t) AS body_hash FROM (
  SELECT page_id, {_visible("regexp_extract(html, '(?is)<article(?:\\s[^>]*)?>(.*?)</article>', 1)")} AS t FROM pages)""")
def first_matching_selector(spark, folder):
    body = html.first_matching_selector(F.col("html"), rules.BODY_SELECTORS + ["article", "body"])
    return _pages(spark, folder).select("page_id", body.alias("t")).select(
        "page_id", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("body_hash")
    )


@query("strip_html", f"SELECT page_id, length(t) AS n_chars, md5(t) AS text_hash FROM (SELECT page_id, {_visible('html')} AS t FROM pages)")
def strip_html(spark, folder):
    body = html.strip_html(F.col("html"))
    return _pages(spark, folder).select("page_id", body.alias("t")).select(
        "page_id", F.length("t").cast("long").alias("n_chars"), F.md5("t").alias("text_hash")
    )


@query("next_page_link", f"""
WITH {LINKS} SELECT page_id, coalesce(arg_min(href, i) FILTER (regexp_matches(href, '/[A-Z]') AND i = 1),
       arg_max(href, i) FILTER (regexp_matches(href, '/[A-Z]'))) AS next FROM links GROUP BY page_id""")
def next_page_link(spark, folder):
    """Capitalised links stand for page links, the second link for one labelled next."""
    second = F.regexp_replace("html", r"(?s)^(.*?<li>.*?<li><a href=\"[^\"]*\">)", "$1Next ")
    return _pages(spark, folder).select("page_id", html.next_page_link(second, "/[A-Z]").alias("next"))


PARAGRAPHS = {"card": r"(?is)<p>(.*?)</p>"}
# Two layouts: list items whose link is the title; articles in boxes within boxes.
LIST = {"card": "li", "title": "a", "link": "a"}
BOXES = {"card": "div.box", "title": "h1, h2", "link": "a[href*=http]", "text": "article"}
IS_BLOG = "contains(regexp_extract(url, 'https?://([^/:]+)', 1), 'blog.')"


@query("extract_entries", f"""
WITH listed AS (SELECT url, unnest(range(len(a))) AS ordinal, unnest(a) AS card FROM (
    SELECT url, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS a FROM pages WHERE {IS_BLOG}) WHERE len(a) > 0),
boxed AS (SELECT url, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS a FROM pages WHERE NOT {IS_BLOG})
SELECT url, CAST(ordinal AS INTEGER) AS ordinal, {_visible("regexp_extract(card, '<a [^>]*>(.*?)</a>', 1)")} AS title,
       regexp_extract(card, 'href="([^"]*)"', 1) AS entry_url, md5({_visible("card")}) AS body_hash FROM listed
UNION ALL
SELECT url, 0, {_visible("regexp_extract(a, '(?s)<h1>(.*?)</h1>', 1)")}, url, md5({_visible("a")}) FROM boxed""")
def extract_entries(spark, folder):
    """Pages whose articles sit in nested boxes, with the same tags in comments, scripts and attributes."""
    noise = "<!-- <div class='box'> --><script>var t = \"<div class='box'></div>\";</script>"
    box = F.concat(F.lit(f'{noise}<div title="</div> <div>" class="wide box"><div><div class=inner>{noise}<a href="/no">no</a><a href="'),
                   "url", F.lit('">x</a></div></div><article>'))
    pages = _pages(spark, folder).withColumn(
        "html", F.replace(F.replace("html", F.lit("<article>"), box), F.lit("</article>"), F.lit("</article><div></div></div>")))
    found = jobs.extract_entries(pages, "url", "html", [("blog.", LIST), ("example", BOXES)])
    return found.select("url", "ordinal", "title", "entry_url", F.md5("body").alias("body_hash"))


@query("entry_stoplist", f"""
WITH cards AS (SELECT page_id, unnest(regexp_extract_all(html, {q(PARAGRAPHS['card'])}, 1)) AS card FROM pages),
t AS (SELECT page_id, {_visible('card')} AS body FROM cards),
h AS (SELECT page_id, left(regexp_extract(body, '^([^.]*)', 1), 100) AS title, left(body, 5000) AS body FROM t)
SELECT page_id, count(*) AS n_entries, CAST(sum(length(title)) AS BIGINT) AS n_title, CAST(sum(length(body)) AS BIGINT) AS n_body
FROM h WHERE title NOT IN ('', 'The', 'Of', 'Ietzte') GROUP BY page_id""")
def entry_stoplist(spark, folder):
    cards = F.regexp_extract_all("html", F.lit(PARAGRAPHS["card"]), F.lit(1))
    t = _pages(spark, folder).select("page_id", F.explode(F.transform(cards, html.strip_html)).alias("body"))
    h = t.select(
        "page_id", F.left(F.regexp_extract("body", "^([^.]*)", 1), F.lit(100)).alias("title"),
        F.left("body", F.lit(5000)).alias("body"),
    )
    stop = rules.NAVIGATION_TITLES + ["The", "Of", "Ietzte"]
    kept = h.filter((F.col("title") != "") & ~F.col("title").isin(stop))
    return kept.groupBy("page_id").agg(
        F.count("*").alias("n_entries"), F.sum(F.length("title")).alias("n_title"), F.sum(F.length("body")).alias("n_body")
    )
