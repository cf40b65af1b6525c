"""Embedding near-dedup by int8 tile products with proven error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposura.llm.common import saved
from exposura.llm.minhash import components

COSINE = 0.98
TILE = 2048
STRIP = 256


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scale, length of the coded vector, length of the error) per row."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None])
    coded = codes * scale[:, None]
    return codes.astype(np.int8), scale, np.linalg.norm(coded, axis=1), np.linalg.norm(unit - coded, axis=1)


def linked_pairs(a: np.ndarray, b: np.ndarray, least: float = COSINE) -> np.ndarray:
    """Boolean matrix of cosine >= least between the rows of a and of b.

    With u = s*q + e for either side, u.v differs from the product of the codes by at
    most |e_u| + |s_u*q_u| * |e_v|. Only pairs that the bound leaves open are computed
    in double precision; codes are multiplied as whole numbers, exactly.
    """
    a, b = a.astype(np.float64), b.astype(np.float64)
    length_a, length_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    qa, sa, ca, ea = quantised(a / length_a[:, None])
    qb, sb, _, eb = quantised(b / length_b[:, None])
    exact = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    wide = qb.astype(exact).T
    out = np.zeros((len(a), len(b)), bool)
    for at in range(0, len(a), STRIP):
        part = slice(at, at + STRIP)
        close = (qa[part].astype(exact) @ wide) * sa[part, None] * sb + ea[part, None] + ca[part, None] * eb
        i, j = np.nonzero(close >= least - 1e-5)
        for cut in range(0, len(i), 1 << 17):
            p, q = i[cut:cut + (1 << 17)] + at, j[cut:cut + (1 << 17)]
            cosine = np.einsum("ij,ij->i", a[p], b[q]) / (length_a[p] * length_b[q])
            out[p, q] = cosine >= least
    return out


def scaled(v: np.ndarray) -> np.ndarray:
    """The vector times the power of two that brings its largest component to between one
    half and one: no cosine changes, and no square is too large or too small."""
    return np.ldexp(v, -np.frexp(np.abs(v).max())[1]) + 0.0


def _valid(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows vec_id, label, vec: bytes of the float64 components; null where it links with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = []
            for x in batch.column(2):
                vec = None
                if x.is_valid and len(x) and x.values.null_count == 0:
                    v = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                    if np.isfinite(v).all() and v.any():
                        vec = scaled(v).tobytes()
                vectors.append(vec)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vectors, pa.binary())], ["vec_id", "label", "vec"])

    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("x"))
    return rows.mapInArrow(run, "vec_id long, label string, vec binary")


def _tile_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, list, list]]:
    held, key = ([], [], [], []), None
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
        rows = zip(*(batch.column(k).to_pylist() for k in range(4, 8)))
        for new, row in zip(keys, rows):
            if new != key:
                if held[0]:
                    yield held
                held, key = ([], [], [], []), new
            for column, value in zip(held, row):
                column.append(value)
    if held[0]:
        yield held


def vector_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = COSINE, tile: int = TILE,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors of one label (and dimension) link when their cosine in double precision
    is at least `least`. n_links counts the other vectors linked directly, copies
    included. Null labels, null, empty and zero vectors and those with null or
    non-finite components have no links and are their own component; a null id has
    none, a null component and stays. An empty table gives no rows; other columns are not read.

    Equal vectors become one with a count. Each label is dealt into tiles of about
    `tile` vectors, and each pair of tiles is one task's work, so a label of any
    size is spread and no task holds more than two tiles. A task hands over sums of
    links per vector and a star per component, not pairs. All pairs of a label are
    covered, so the work grows with the square of the largest label.
    """
    drawn = saved(_valid(df, id_col, vector_col, label_col), "vec-drawn")
    valid = drawn.where("vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL")
    classes = saved(valid.groupBy("label", "vec").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size")), "vec-classes")
    rows = classes.withColumn("dim", F.octet_length("vec"))
    tiles = rows.groupBy("label", "dim").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    placed = rows.join(tiles, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("rep"), "tiles"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    spread = placed.select("label", "dim", "tile", other, "rep", "size", "vec").select(
        "label", "dim", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
        "rep", "size", "vec", (F.col("tile") > F.col("other")).cast("int").alias("side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for reps, sizes, vectors, sides in _tile_groups(batches):
            x = np.frombuffer(b"".join(vectors), np.float64).reshape(len(reps), -1)
            side, size, ids = np.array(sides), np.array(sizes), np.array(reps)
            first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            alone = not len(second) or not len(first)
            if alone:
                first = second = np.arange(len(ids))
            near = linked_pairs(x[first], x[second], least)
            if alone:
                np.fill_diagonal(near, False)
            total = np.zeros(len(ids), np.int64)
            total[first] += near @ size[second]
            if not alone:
                total[second] += size[first] @ near
            label = ids.copy()
            i, j = np.nonzero(near)
            while True:
                before = label.copy()
                np.minimum.at(label, first[i], label[second[j]])
                np.minimum.at(label, second[j], label[first[i]])
                if (before == label).all():
                    break
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(label[at]), pa.array(total[at])], ["a", "b", "n"])

    dealt = spread.repartition("label", "dim", "low", "high").sortWithinPartitions("label", "dim", "low", "high", "side", "rep")
    columns = dealt.select("label", "dim", "low", "high", "rep", "size", "vec", "side")
    met = saved(columns.mapInArrow(run, "a long, b long, n long"), "vec-met")
    links = met.groupBy("a").agg(F.sum("n").alias("n"))
    labels = components(met)
    resolved = (
        classes.join(links, classes.rep == links.a, "left").join(labels, F.col("rep") == F.col("id"), "left")
        .select("label", "vec", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("comp", "rep").alias("comp"))
    )
    with_id = F.col("vec_id").isNotNull()
    found = F.when(with_id, F.coalesce("comp", "vec_id"))
    return drawn.join(resolved, ["label", "vec"], "left").select(
        "vec_id", F.when(with_id, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        found.alias("component_id"), F.coalesce(F.col("vec_id") == found, F.lit(True)).alias("kept"))
