"""Language identification by rank-order n-gram profiles."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from exposura.llm.common import id_remainder

LONGEST = 3
PROFILE = 300
WORDS_HELD = 300_000
GRAMS_HELD = 1 << 16
WORDS = re.compile(r"[^\W\d_]+")
BASE = 1 << 21


class GramIds(dict):
    """Ids of n-grams, counting up as they are met; `order` holds their code points as one number."""

    def __init__(self):
        super().__init__()
        self.names: list[str] = []
        self.order = np.zeros(1024, np.int64)

    def __missing__(self, gram: str) -> int:
        found = self[gram] = len(self.names)
        self.names.append(gram)
        if found == len(self.order):
            self.order = np.concatenate([self.order, np.zeros_like(self.order)])
        key = 0
        for k in range(LONGEST):
            key = key * BASE + (ord(gram[k]) + 1 if k < len(gram) else 0)
        self.order[found] = key
        return found


    def forget(self, kept: int) -> None:
        """Drops all but the first n-grams; the ids of the others are given out again."""
        del self.names[kept:]
        super().clear()
        self.update((gram, k) for k, gram in enumerate(self.names))


class Grams(dict):
    """Word to the ids of its n-grams, a blank at either end."""

    def __init__(self):
        super().__init__()
        self.ids = GramIds()

    def __missing__(self, word: str) -> np.ndarray:
        letters = word if word.isalpha() else "".join(c for c in word if c.isalpha())
        grams: list[str] = []
        if letters:
            padded, size = f" {letters} ", len(letters) + 2
            grams += letters
            for n in range(2, LONGEST + 1):
                grams += [padded[k:k + n] for k in range(size - n + 1)]
        found = self[word] = np.fromiter(map(self.ids.__getitem__, grams), np.int32, len(grams))
        return found

    def trim(self, kept: int = 0) -> None:
        """Empties full tables; n-grams of the first `kept` ids stay. Between texts only."""
        full = len(self.names) > kept + GRAMS_HELD
        if full or len(self) > WORDS_HELD:
            self.clear()
        if full:
            self.ids.forget(kept)

    @property
    def names(self) -> list[str]:
        return self.ids.names

    def count(self, words: Counter) -> np.ndarray:
        """Occurrences by n-gram id."""
        parts = [self[w] for w in words]
        if not parts:
            return np.zeros(0)
        times = np.repeat(np.fromiter(words.values(), np.float64, len(parts)), [len(p) for p in parts])
        return np.bincount(np.concatenate(parts), times)

    def top(self, counts: np.ndarray, k: int) -> np.ndarray:
        """Ids of the k most frequent n-grams, in rank order; ties by code points."""
        at = np.flatnonzero(counts)
        if len(at) > k:
            at = at[counts[at] >= np.partition(counts[at], len(at) - k)[len(at) - k]]
        return at[np.lexsort((self.ids.order[at], -counts[at]))][:k]


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


def learn_profiles(df: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """Rows lang, gram, rank (from 0): the most frequent n-grams of each language.

    Every whole text with a language counts. Tasks add up words, then n-grams, and
    hand over sums only. Null texts and languages add nothing; ties by code points.
    """
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, words = Grams(), {}

        def sums() -> Iterator[pa.RecordBatch]:
            for lang, seen in words.items():
                counts = grams.count(seen)
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array([grams.names[k] for k in at], pa.string()),
                     pa.array(counts[at].astype(np.int64))], ["lang", "gram", "n"])
            words.clear()
            grams.trim()

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1)):
                words.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
                if sum(map(len, words.values())) > WORDS_HELD:
                    yield from sums()
        yield from sums()

    rows = df.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    counts = rows.mapInArrow(tally, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return counts.select("lang", "gram", (rank - 1).alias("rank")).where(F.col("rank") < size)


class Matcher:
    """Out-of-place distances of a text to the profiles."""

    def __init__(self, profiles: dict[str, list[str]], size: int = PROFILE):
        self.langs, self.size, self.grams = sorted(profiles), size, Grams()
        for lang in self.langs:
            for gram in profiles[lang]:
                self.grams.ids[gram]
        self.place = np.full((len(self.langs), len(self.grams.names)), -1)
        for row, lang in enumerate(self.langs):
            for rank, gram in enumerate(profiles[lang]):
                self.place[row, self.grams.ids[gram]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        self.grams.trim(self.place.shape[1])
        mine = self.grams.top(self.grams.count(Counter(words_of(text))), self.size)
        if not len(mine) or not self.langs:
            return "und", 0.0
        known = mine < self.place.shape[1]
        place = self.place[:, mine[known]]
        apart = np.where(place < 0, self.size, np.abs(place - np.flatnonzero(known)))
        distance = apart.sum(axis=1) + self.size * int((~known).sum())
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(mine)))


_matchers: dict = {}


def identify(df: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = PROFILE) -> DataFrame:
    """Rows doc_id, lang_pred, score for every whole text.

    The score is one less the share of the greatest possible distance. `und`, with
    score 0, for a null text, a text without letters and where nothing was learned;
    equal distances: the first language by code points. Rows are independent, other
    columns are not read, no shuffle. The profiles, `size` n-grams for each
    language, go to the tasks.
    """
    learned: dict[str, list[str]] = {}
    for row in profiles.orderBy("lang", "rank").collect():
        learned.setdefault(row["lang"], []).append(row["gram"])
    sent = df.sparkSession.sparkContext.broadcast(learned)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if sent.value is not _matchers.get("for"):
            _matchers.update({"for": sent.value, "is": Matcher(sent.value, size)})
        matcher = _matchers["is"]
        for batch in batches:
            found = [matcher.predict(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    return id_remainder(F.col(id_col), 4) == 2
