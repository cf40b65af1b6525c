"""Predicates and filters. Each returns a Column unless it says otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from exposura import rules
from exposura.functions import text, times


def contains_literal(c: Column, s: str) -> Column:
    return c.contains(s)


def ci_search(cols: list[Column], q: str) -> Column:
    return reduce(lambda a, b: a | b, [F.lower(c).contains(q.lower()) for c in cols])


def array_ci_search(arr: Column, q: str) -> Column:
    return F.exists(arr, lambda k: F.lower(k).contains(q.lower()))


def regex_search(c: Column, pattern: str) -> Column:
    return c.rlike(f"(?i){pattern}")


def like_search(c: Column, term: str) -> Column:
    return c.ilike(f"%{term}%")


def sender_filter(term: str) -> Column:
    return (
        like_search(F.col("username"), term)
        | like_search(F.col("first_name"), term)
        | like_search(F.col("last_name"), term)
    )


def is_video(path: Column) -> Column:
    ends = "|".join(s[1:] for s in rules.VIDEO_SUFFIXES)
    return F.coalesce(path.rlike(rf"(?i)\.({ends})$"), F.lit(False))


def media_filter(kind: str) -> Column:
    """photo, video, doc, text or any."""
    media, path = F.col("media_type"), F.col("media_path")
    document = media == "MessageMediaDocument"
    return {
        "photo": media == "MessageMediaPhoto",
        "video": document & is_video(path),
        "doc": document & ~is_video(path),
        "text": media.isNull() & (F.col("message") != ""),
        "any": media.isNotNull() & (media != "MessageMediaWebPage"),
    }[kind]


def min_views(n: int) -> Column:
    return F.col("views") >= n


def advanced_search(
    df: DataFrame,
    text_term: str = "",
    pattern: str = "",
    start: str = "",
    end: str = "",
    sender: str = "",
    media: str = "",
    views: int | None = None,
    channels: list | None = None,
    limit: int = 50,
) -> DataFrame:
    """Rows under all given filters, newest first; the limit is held within 1..500."""
    tests: list[Column] = []
    if text_term:
        tests.append(like_search(F.col("message"), text_term))
    if pattern:
        tests.append(regex_search(F.col("message"), pattern))
    if start or end:
        tests.append(times.in_days(F.col("date"), start, end))
    if sender:
        tests.append(sender_filter(sender))
    if media:
        tests.append(media_filter(media))
    if views is not None:
        tests.append(min_views(views))
    if channels:
        tests.append(select_channels(channels))
    found = df.filter(reduce(lambda a, b: a & b, tests)) if tests else df
    return found.orderBy(F.desc("date"), "channel", "message_id").limit(max(1, min(limit, 500)))


def message_kind() -> Column:
    """text, image, video or document; a web preview counts as text."""
    media = F.col("media_type")
    return (
        F.when(media.isNull() | (media == "MessageMediaWebPage"), "text")
        .when(media == "MessageMediaPhoto", "image")
        .when((media == "MessageMediaDocument") & is_video(F.col("media_path")), "video")
        .when(media == "MessageMediaDocument", "document")
    )


def missing_media() -> Column:
    media = F.col("media_type")
    return (
        media.isNotNull()
        & (media != "MessageMediaWebPage")
        & (F.coalesce(F.col("media_path"), F.lit("")) == "")
    )


def nested_filter(arr: Column, pred) -> Column:
    return F.exists(arr, pred)


def term_query(c: Column, value) -> Column:
    return c == F.lit(value)


def match_query(c: Column, words: str) -> Column:
    """Any of the words is a token of the text."""
    tokens = F.split(F.lower(c), r"[^\p{L}\p{N}]+")
    wanted = [w for w in words.lower().split() if w]
    return F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in wanted]))


def range_query(c: Column, low=None, high=None) -> Column:
    out = F.lit(True)
    if low is not None:
        out = out & (c >= low)
    if high is not None:
        out = out & (c <= high)
    return out


def table_filter(
    c: Column, include: list[str] | None = None, exclude: list[str] = rules.IGNORED_TABLES
) -> Column:
    """Names in the whitelist, if any, and not ignored; the ignore list wins."""
    low = F.lower(c)
    out = ~low.isin([e.lower() for e in exclude]) if exclude else F.lit(True)
    return out & low.isin([i.lower() for i in include]) if include else out


def select_channels(channels: str | list) -> Column:
    return F.lit(True) if channels == "all" else F.col("channel").isin(list(channels))


def notable_processes(
    df: DataFrame, system: list[str] = rules.SYSTEM_PROCESSES, noise: list[str] = rules.PROCESS_NOISE
) -> DataFrame:
    """(name, pid) once per lower-cased name, the lowest pid first; system names dropped."""
    low = F.lower(F.col("name"))
    kept = df.filter(~low.isin([s.lower() for s in system]) & ~text.contains_any(low, noise))
    once = kept.groupBy(low.alias("key")).agg(
        F.min(F.struct("pid", "name")).alias("first")
    )
    return once.select("first.name", "first.pid").orderBy("pid", "name")


def valid_alias_key(c: Column) -> Column:
    """False for values that were taken for a header name."""
    s = text.strip(c)
    return (
        (s != "")
        & (F.length(s) <= 50)
        & ~s.rlike(r"^[0-9]+$")
        & ~s.rlike(r"^[^@\s]+@[^@\s]+\.[^@\s]+$")
        & ~s.rlike(r"[\[\]{}\"']")
        & ~s.rlike(r"[\x00-\x08\x0e-\x1f]")
        & ~s.contains("�")
    )


def log_filter(level: str = "", q: str = "") -> Column:
    out = F.lit(True)
    if level:
        out = out & (F.col("level") == level)
    if q:
        out = out & F.lower(F.col("message")).contains(q.lower())
    return out


def source_type_filter(kind: str) -> Column:
    return F.lit(True) if kind == "all" else F.col("source_type") == kind
