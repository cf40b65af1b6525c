"""Near-dedup: fast similarity sketches, banding, exact verification, components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from exposura.llm.common import saved

WIDTH = 5
SKETCH = 192
MISSED = 3.1e-7
THRESHOLD = (85, 100)
BLOCK = 256
SALTS = 64
WORDS_HELD = 500_000

_rng = np.random.default_rng(20240501)
_MIX = [int(x) | 1 for x in _rng.integers(1, 2**63, WIDTH, dtype=np.uint64)]
_FACTORS = np.array(_MIX, np.uint64)
_SEEDS = _rng.integers(1, 2**63, 2 * SKETCH, dtype=np.uint64) | np.uint64(1)
_BAND = _rng.integers(1, 2**63, SKETCH, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


_words = WordHashes()


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's word shingles.

    A-Z are lower-cased; a text with fewer words than the width is one shingle; no
    words, no shingle.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_words) > WORDS_HELD:
        _words.clear()
    h = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    n = min(width, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        total += h[k:len(h) - n + 1 + k] * _FACTORS[k]
    return np.unique(mixed(total))


def sketch(items: np.ndarray, size: int = SKETCH, seeds: np.ndarray = _SEEDS) -> np.ndarray:
    """Fast similarity sketch of a non-empty set, one number per coordinate.

    Round i throws every item at one coordinate with a value of i plus a fraction,
    the least value stays, so a later round only fills what is still empty. In the
    first `size` rounds the coordinate is hashed; in round size + j it is j, which
    fills whatever is left. Rounds are computed in groups; the result is that of
    taking them one by one. Cost is in the order of items plus size * log(size).
    """
    out = np.zeros(size, np.uint64)
    empty = np.ones(size, bool)
    per, done = np.uint64(size), 0
    while empty.any() and done < size:
        rounds = min(size - done, max(1, int(1.2 * size * (np.log(empty.sum()) + 1.5) / len(items))))
        h = mixed(items[None, :] ^ seeds[done:done + rounds, None])
        at = ((h >> np.uint64(32)) * per >> np.uint64(32)).ravel()
        level = np.repeat(np.arange(done, done + rounds, dtype=np.uint64), len(items))
        key = (at << np.uint64(54)) | (level << np.uint64(44)) | (h.ravel() & np.uint64((1 << 44) - 1))
        key.sort()
        where = key >> np.uint64(54)
        first = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
        spot = where[first].astype(np.int64)
        fill = empty[spot]
        out[spot[fill]] = key[first[fill]]
        empty[spot] = False
        done += rounds
    for j in np.flatnonzero(empty):
        out[j] = (np.uint64(j) << np.uint64(54)) | (mixed(items ^ seeds[size + j]) >> np.uint64(10)).min() | np.uint64(1 << 53)
    return out


def banding(threshold: tuple[int, int] = THRESHOLD) -> tuple[int, int]:
    """(bands, rows): the widest bands of a sketch by which a pair at the threshold
    is missed with probability MISSED at most."""
    share = threshold[0] / threshold[1]
    for rows in range(SKETCH, 0, -1):
        least = math.log(MISSED) / math.log1p(-share**rows) if share < 1 else 1
        if math.ceil(least) * rows <= SKETCH:
            return math.ceil(least), rows
    raise ValueError(f"a sketch of {SKETCH} coordinates does not find pairs at {share}")


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    factors = _BAND[:bands * rows].reshape(bands, rows)
    return mixed((values.reshape(bands, rows) * factors).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).view(np.int64)


SKETCHED = "doc_id long, of long, n long, digest binary, bands array<long>"


def sketches(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Rows doc_id, of (hash of the text), n (set size), digest of the set and band keys;
    both null for an empty set."""
    count, rows = banding(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                sizes, digests, bands = [], [], []
                for text in part.column(2):
                    items = shingles(text.as_py())
                    sizes.append(len(items))
                    digests.append(xxhash.xxh3_128_digest(items.tobytes()) if len(items) else None)
                    bands.append(band_keys(sketch(items, count * rows), count, rows) if len(items) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                    ["doc_id", "of", "n", "digest", "bands"])

    text = F.col(text_col)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("of"), text.alias("text")).mapInArrow(run, SKETCHED)


def hub_pairs(reps: DataFrame) -> DataFrame:
    """Distinct (hub, member), hub itself included, for rows (rep, bands).

    Each bucket with two or more sets has as hub its member in the largest buckets,
    which in a group of copies is the text they were made from; members of a bucket
    meet under its hub. Counts and picks combine in every task before they move.
    """
    buckets = saved(reps.select("rep", F.explode("bands").alias("key")), "near-buckets")
    counts = buckets.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    members = saved(buckets.join(counts, "key"), "near-members")
    weight = members.groupBy("rep").agg(F.sum("m").alias("weight"))
    hubs = members.join(weight, "rep").groupBy("key").agg(F.max(F.struct("weight", F.negate("rep").alias("rep"))).alias("best"))
    hubs = hubs.select("key", F.negate("best.rep").alias("hub"))
    return saved(members.select("key", "rep").join(hubs, "key").select("hub", F.col("rep").alias("member")).distinct(), "near-pairs")


class Linker:
    """Links between sets of one block, joined up as they are found.

    A later set is compared with every earlier one of another component that it can
    link to: two sets at the threshold share one of the first
    n - ceil(threshold * n) + 1 items of either, in any one order; items are ordered
    by how rare they are in the block. Counts of shared items confirm a link.
    """

    def __init__(self, sets: list[np.ndarray], ids: list[int], threshold: tuple[int, int] = THRESHOLD):
        self.ids, self.parent = ids, list(range(len(ids)))
        self.numerator, self.denominator = threshold
        self.sizes = np.array([len(s) for s in sets])
        everything, inverse = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.zeros(0), np.zeros(0, int))
        rare = np.argsort(np.argsort(np.bincount(inverse, minlength=len(everything)), kind="stable"))
        ends = np.cumsum(self.sizes)
        self.sets = [np.sort(rare[inverse[e - n:e]]) for e, n in zip(ends, self.sizes)]

    def root(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def linked(self, a: int, b: int) -> bool:
        small, large = sorted((self.sizes[a], self.sizes[b]))
        if small * self.denominator < large * self.numerator:
            return False
        shared = len(np.intersect1d(self.sets[a], self.sets[b], assume_unique=True))
        return shared * self.denominator >= self.numerator * (small + large - shared)

    def links(self, hub: int, queries: list[int], others: list[int] | None = None) -> list[tuple[int, int]]:
        """Links that join the components: of the hub first, then among queries (and others)."""
        found = []

        def join(a: int, b: int) -> None:
            ra, rb = self.root(a), self.root(b)
            if ra != rb and self.linked(a, b):
                self.parent[ra] = rb
                found.append((self.ids[a], self.ids[b]))

        if hub >= 0:
            for k in queries:
                join(hub, k)
        index: dict[int, list[int]] = {}
        for k in others or []:
            for item in self._prefix(k):
                index.setdefault(item, []).append(k)
        for k in queries:
            prefix = self._prefix(k)
            met = {other for item in prefix for other in index.get(item, ())}
            for other in sorted(met):
                join(k, other)
            if others is None:
                for item in prefix:
                    index.setdefault(item, []).append(k)
        return found

    def _prefix(self, k: int) -> list[int]:
        n = int(self.sizes[k])
        return self.sets[k][:n - -(-self.numerator * n // self.denominator) + 1].tolist()


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Runs of rows with one (hub, block), of batches sorted by them."""
    held, key = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if (row["hub"], row["block"]) != key:
                if held:
                    yield held
                held, key = [], (row["hub"], row["block"])
            held.append(row)
    if held:
        yield held


def _linked(rows: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Links of the rows (hub, block, role, id, comp, text), one (hub, block) at a time.

    Role 0 is the hub, 1 a query, 2 a row that queries are compared with.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _grouped(batches):
            linker = Linker([shingles(r["text"]) for r in group], [r["id"] for r in group], threshold)
            by_comp: dict[int, int] = {}
            for k, r in enumerate(group):
                if r["comp"] is not None:
                    linker.parent[k] = by_comp.setdefault(r["comp"], k)
            role = [[k for k, r in enumerate(group) if r["role"] == want] for want in (0, 1, 2)]
            found = linker.links(role[0][0] if role[0] else -1, role[1], role[2] if role[2] else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], ["a", "b"])

    dealt = rows.repartition("hub", "block").sortWithinPartitions("hub", "block", "role", "id")
    return dealt.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """Rows (id, comp): the smallest id each linked id can reach.

    Every round gives an id the least label among itself and its neighbours, then
    the label of that label; rounds end when no label changes. Labels combine in
    every task before they move, so an id with very many links is no burden.
    """
    edges = saved(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "cc-edges")
    least = edges.groupBy("a").agg(F.min("b").alias("b"))
    labels = saved(least.select(F.col("a").alias("id"), F.least("a", "b").alias("comp")), "cc-labels")
    while True:
        near = edges.join(labels, edges.b == labels.id).groupBy("a").agg(F.min("comp").alias("near"))
        step = labels.join(near, labels.id == near.a).select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        of = labels.select(F.col("id").alias("of"), F.col("comp").alias("further"))
        jumped = saved(
            step.join(of, step.comp == of.of, "left")
            .select("id", "old", F.least("comp", F.coalesce("further", "comp")).alias("comp")), "cc-labels")
        labels = jumped.select("id", "comp")
        if jumped.where("comp <> old").isEmpty():
            return labels


def _by_hub(rows: DataFrame, hubs: DataFrame) -> DataFrame:
    """Left join of rows (hub, member, ..) with a row per hub; a hub's rows are dealt over SALTS tasks."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("member"), F.lit(SALTS)))
    copies = hubs.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, ["hub", "salt"], "left").drop("salt")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents link when |A and B| / |A or B| is at least the threshold, a fraction
    (85, 100), over their sets of five-word shingles, confirmed on the full sets; component_id is the smallest id that links
    lead to, itself included. A null text or one without words has no shingles and
    links with nothing. A null id gets a null component and stays. Rows that repeat
    an id and its text share one answer; rows of one id with different texts each have
    their own text's component. An empty table gives no rows; other columns are not read.

    1. Sketch every text; rows with one set become one, with a number of its own.
    2. Bands as `banding` has them, 32 of 6 coordinates at 0.85 and 38 of 5 at 0.80: a
       pair at the threshold shares no band with probability 3e-7, less above it. A
       bucket's sets meet under its hub.
    3. A hub's sets are verified in blocks of at most `block` sets: hub first, then
       every pair of a block not joined yet.
    4. Hubs with more than one block: sets still apart from their hub are compared, as
       queries, with the hub's other blocks. No pair is left out for the size of
       its bucket, and no task holds more than two blocks.
    """
    drawn = saved(sketches(df, id_col, text_col, threshold), "near-sketches")
    filled = drawn.where("n > 0 AND doc_id IS NOT NULL")
    reps = filled.groupBy("digest").agg(F.min(F.struct("doc_id", "of", "bands")).alias("r"))
    reps = saved(reps.select("digest", "r.*").withColumn("rep", F.monotonically_increasing_id()), "near-reps")
    pairs = hub_pairs(reps)

    wanted = pairs.select(F.col("member").alias("rep")).union(pairs.select("hub")).distinct()
    named = reps.select("rep", F.col("doc_id").alias("its_id"), F.col("of").alias("its_text")).join(wanted, "rep", "left_semi")
    texts = df.select(F.col(id_col).cast("long").alias("its_id"), F.col(text_col).alias("text")).withColumn("its_text", F.xxhash64("text"))
    met = texts.join(named.hint("merge"), ["its_id", "its_text"])
    texts = saved(met.groupBy(F.col("rep").alias("id")).agg(F.min("text").alias("text")), "near-texts")

    large = pairs.groupBy("hub").agg(F.count("*").alias("size")).where(F.col("size") > block).select(
        "hub", F.ceil(F.col("size") / block).alias("blocks"))
    placed = _by_hub(pairs.where("hub <> member"), large).withColumn("blocks", F.coalesce("blocks", F.lit(1))).select(
        "hub", "member", "blocks", F.pmod(F.xxhash64("member"), "blocks").alias("block"))
    placed = saved(placed, "near-placed")

    def with_texts(rows: DataFrame) -> DataFrame:
        return rows.join(texts, "id").select("hub", "block", "role", "id", "comp", "text")

    none = F.lit(None).cast("long").alias("comp")
    first = placed.select("hub", "block", F.lit(1).alias("role"), F.col("member").alias("id"), none).union(
        placed.select("hub", "block", F.lit(0).alias("role"), F.col("hub").alias("id"), none).distinct())
    links = saved(_linked(with_texts(first), threshold), "near-links")
    labels = components(links)

    wide = placed.where("blocks > 1")
    if not wide.isEmpty():
        own = wide.join(labels, wide.member == labels.id, "left").select(
            "hub", "member", "block", "blocks", F.coalesce("comp", "member").alias("comp"))
        hub_comp = labels.select(F.col("id").alias("hub"), F.col("comp").alias("hub_comp"))
        hub_comp = hub_comp.join(wide.select("hub").distinct(), "hub", "left_semi")
        own = saved(_by_hub(own, hub_comp).withColumn("hub_comp", F.coalesce("hub_comp", "hub")), "near-apart")
        apart = own.where("comp <> hub_comp").withColumn("part", F.col("block"))
        queries = apart.select("hub", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), "member", "comp", "block")
        cells = queries.select(F.col("hub").alias("of"), "part", "other").distinct()
        others = own.join(cells, (F.col("hub") == F.col("of")) & (F.col("block") == F.col("other"))).select(
            "hub", "part", "other", F.lit(2).alias("role"), F.col("member").alias("id"), "comp")
        asked = queries.where("block <> other").select(
            "hub", "part", "other", F.lit(1).alias("role"), F.col("member").alias("id"), "comp")
        both = asked.union(others.where("part <> other"))
        both = both.select("hub", F.concat_ws("-", "part", "other").alias("block"), "role", "id", "comp")
        more = _linked(with_texts(both), threshold)
        links = saved(links.union(more), "near-links")
        labels = components(links)

    classes = saved(reps.join(labels, reps.rep == labels.id, "left").select("digest", "doc_id", F.coalesce("comp", "rep").alias("class")), "near-classes")
    smallest = classes.groupBy("class").agg(F.min("doc_id").alias("comp"))
    named = classes.join(smallest, "class").select("digest", "comp")
    found = F.when(F.col("doc_id").isNotNull(), F.coalesce("comp", "doc_id"))
    return drawn.join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), found.alias("component_id"),
        F.coalesce(F.col("doc_id") == found, F.lit(True)).alias("kept"))
