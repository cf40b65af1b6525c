"""Path and file-content functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from exposura import rules


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def md5_digest(c: Column) -> Column:
    return F.md5(c)


def is_executable_magic(content: Column) -> Column:
    """ELF, MZ or a shebang, read from the first bytes."""
    head = F.hex(F.substring(content, 1, 4))
    return head.startswith("7F454C46") | head.startswith("4D5A") | head.startswith("2321")


def depth_level(path: Column, is_directory: Column) -> Column:
    parts = F.size(F.split(path, "/"))
    return F.when(is_directory, parts - 1).otherwise(parts)


def filename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-cased suffix with its dot; "" without one."""
    return F.lower(F.regexp_extract(filename(path), r"^.+(\.[^.]*[^.])$", 1))


def parent_directory(path: Column) -> Column:
    """Name of the directory that holds the path; "" at the root."""
    return F.regexp_extract(path, r"([^/]+)/[^/]*$", 1)


def parent_path(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def in_skipped_dir(path: Column, names: list[str] = rules.SKIPPED_DIRS) -> Column:
    return F.arrays_overlap(F.split(path, "/"), F.array(*[F.lit(n) for n in names]))


def file_family(path: Column) -> Column:
    """Archive, binary, one of the text parsers, or metadata only."""
    low = F.lower(filename(path))
    ext = extension(path)
    out = F.when(
        low.rlike(r"\.(tar\.gz|tgz|tar\.bz2|tbz2|tar\.xz|txz)$") | ext.isin(rules.ARCHIVE_SUFFIXES), "archive"
    ).when(ext.isin(rules.BINARY_SUFFIXES), "binary")
    for suffix, parser in rules.TEXT_SUFFIXES.items():
        out = out.when(ext == suffix, parser)
    return out.otherwise("metadata")
