"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from exposura.llm.common import saved
from exposura.llm.transducer import _byte_letters

PAIRS_IN_MEMORY = 2_000_000
BATCH_CHARS = 1 << 20
LONG_TEXT = 1 << 20
SPACE = "▁"


def as_ranks(a_json: str, spelled: list[bytes]) -> tiktoken.Encoding | None:
    """The same tokenizer by ranks, several times faster; None where the file is not of
    the kind whose merges are numbered as their tokens."""
    whole = json.loads(a_json)
    vocab, merges = whole["model"]["vocab"], whole["model"]["merges"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    ordered = all(vocab[a + b] == 256 + k for k, (a, b) in enumerate(pairs))
    plain = whole["pre_tokenizer"] and whole["pre_tokenizer"]["type"] == "ByteLevel" and whole["pre_tokenizer"]["use_regex"]
    if not ordered or not plain or whole["normalizer"]:
        return None
    ranks = {spelled[id_]: id_ for id_ in vocab.values() if id_ < 256 + len(merges)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Tokenizers:
    """The two libraries, and for each id of either the bytes it stands for."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        letters = _byte_letters()
        special = {t.content for t in self.a.get_added_tokens_decoder().values() if t.special}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, id_ in self.a.get_vocab().items():
            self.a_bytes[id_] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.ranks = as_ranks(a_json, self.a_bytes)
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace(SPACE, " ").encode()
            for k in range(self.b.get_piece_size()) for piece in [self.b.id_to_piece(k)]]
        self.a_length = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_length = np.array(list(map(len, self.b_bytes)), np.int64)
        self.named = [np.array([[f"{k}{end}" for k in range(len(side))] for end in (",", "|", ";")], object) for side in (self.a_bytes, self.b_bytes)]

    def left(self, text: str) -> list[int]:
        if self.ranks is None or len(text) > LONG_TEXT:
            return self.a.encode(text, add_special_tokens=False).ids
        return self.ranks.encode_ordinary(text)

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides; none where either does not give the text's bytes back."""
        spaced = [" " + t for t in texts]
        a = list(map(self.left, spaced))
        b = self.b.encode(texts, num_threads=1)
        out = []
        for text, whole, x, y in zip(texts, spaced, a, b):
            data = whole.encode()
            same = text and b"".join(map(self.a_bytes.__getitem__, x)) == data == b"".join(map(self.b_bytes.__getitem__, y))
            out.append((x, y) if same else ([], []))
        return out


def groups_of(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every token of either side, from the byte offsets where tokens end.

    Every token points to the token of the other side that reaches farthest right
    of those it overlaps, which is the one over its last byte; where both end
    together, the left side's token points to itself and the other to it. All
    pointers are doubled at once until none moves: then each token points to the
    last token of its group. The pointers of a group of n tokens settle after
    log2(n) rounds.
    """
    n = len(a_end)
    over_a = np.searchsorted(b_end, a_end, side="left")
    over_b = np.searchsorted(a_end, b_end, side="left")
    ends_a = b_end[over_a] == a_end
    to = np.concatenate([np.where(ends_a, np.arange(n), n + over_a), over_b])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    last = np.flatnonzero(ends_a)
    number = np.searchsorted(last, to)
    return number[:n], number[n:]


def links_of(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of a, token of b, end) of every overlapping pair.

    A pair overlaps in one stretch without an end within it, and every stretch
    between neighbouring ends of either side is one pair's.
    """
    ends = np.sort(np.concatenate([a_end, b_end]))
    ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])] if len(ends) else ends
    return np.searchsorted(a_end, ends), np.searchsorted(b_end, ends), ends


class Aligned:
    """The tokens of several texts laid end to end, and what is counted by text."""

    def __init__(self, tok: Tokenizers, texts: list[str]):
        coded = tok.encode(texts)
        self.n_a = np.array([len(a) for a, _ in coded], np.int64)
        self.n_b = np.array([len(b) for _, b in coded], np.int64)
        a = np.concatenate([np.array(a, np.int64) for a, _ in coded])
        b = np.concatenate([np.array(b, np.int64) for _, b in coded])
        a_end, b_end = np.cumsum(tok.a_length[a]), np.cumsum(tok.b_length[b])
        a_group, b_group = groups_of(a_end, b_end)
        a_link, b_link, _ = links_of(a_end, b_end)
        text_of_a = np.repeat(np.arange(len(coded)), self.n_a)
        self.text = text_of_a[a_link]
        self.key = a[a_link] * len(tok.b_bytes) + b[b_link]
        self.n_links = np.bincount(self.text, minlength=len(coded))
        self.n_groups = self._distinct(a_group, self.n_a)
        self.digests = self._digests(tok, a, b, a_group, b_group)

    @staticmethod
    def _distinct(group: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Groups of each text; a text's groups follow each other."""
        ends = np.cumsum(counts)
        last = np.concatenate([[-1], group])[ends]
        return np.diff(np.concatenate([[-1], np.maximum.accumulate(last)]))

    def _digests(self, tok: Tokenizers, a, b, a_group, b_group) -> list[str]:
        place = np.argsort(np.concatenate([a_group * 2, b_group * 2 + 1]), kind="stable")
        group = np.concatenate([a_group, b_group])[place]
        right = place >= len(a)
        ids = np.concatenate([a, b])[place]
        turn = np.zeros(len(ids), np.int64)
        if len(ids):
            turn[:-1] = np.where(group[1:] != group[:-1], 2, np.where(right[1:] != right[:-1], 1, 0))
        words = np.empty(len(ids), object)
        words[~right] = tok.named[0][turn[~right], ids[~right]]
        words[right] = tok.named[1][turn[right], ids[right]]
        words = words.tolist()
        out, begin = [], 0
        for n in self.n_a + self.n_b:
            spelled = "".join(words[begin:begin + n])[:-1]
            out.append(hashlib.sha256(spelled.encode()).hexdigest() if n else "")
            begin += n
        return out


_tokenizers: dict[str, Tokenizers] = {}


def _loaded(name: str, files) -> Tokenizers:
    if name not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[name] = Tokenizers(*files.value)
    return _tokenizers[name]


FOUND = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, keys array<long>, times array<int>")


def _parts(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts of about a million characters; a longer text is a run of its own."""
    begin = held = 0
    for k, t in enumerate(texts):
        if k > begin and held + len(t) > BATCH_CHARS:
            yield begin, k
            begin, held = k, 0
        held += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def aligned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """Rows doc_id, n_a, n_b, n_groups, n_links, groups_sha256, keys, times.

    `keys` are the pairs of ids a text links (a's id times b's vocabulary size plus
    b's id), each once, `times` how often. One pass, no shuffle; the vocabularies,
    files of fixed size, are broadcast. Texts that are null, empty or not given back
    byte by byte by both tokenizers have no tokens.
    """
    a_path = a_path or public_tokenizers.path("byte_bpe_50k.json")
    b_path = b_path or public_tokenizers.path("piece_bpe_32k.model")
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        files = df.sparkSession.sparkContext.broadcast((a.read(), b.read()))
    name = f"{a_path} {b_path}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _loaded(name, files)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for begin, end in _parts(texts):
                found = Aligned(tok, texts[begin:end])
                size = len(tok.a_bytes) * len(tok.b_bytes)
                pairs = np.sort(found.text * size + found.key)
                at = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]])) if len(pairs) else np.zeros(0, np.int64)
                times = np.diff(np.append(at, len(pairs)))
                pairs = pairs[at]
                starts = np.searchsorted(pairs, np.arange(end - begin + 1) * size).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(starts), pa.array(values)) for values in (pairs % size, times.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin), *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links)),
                     pa.array(found.digests, pa.string()), *lists],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "times"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(run, FOUND)


def align(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None,
    pairs_in_memory: int = PAIRS_IN_MEMORY,
) -> DataFrame:
    """One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a pair of overlapping tokens; its count is how many links of the whole
    corpus join the same two ids. `n_best` counts the links whose count is the
    highest any pair with their right id has, `count_sum` adds up all counts.
    Texts without tokens (see `aligned`) have zeros and an empty groups_sha256. Repeated
    rows count each time and repeat; null ids stay null; an empty table gives no
    rows; other columns are not read.

    Texts are tokenized once; what is kept of each is its distinct pairs. Counts
    combine in every task before they move. The table of pairs goes to every
    task only after it was counted and found to have at most `pairs_in_memory`
    rows; a larger one meets the texts' pairs by key, with hot keys left to adaptive
    skew handling, since the table has one row for each key.
    """
    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path or public_tokenizers.path("piece_bpe_32k.model")).get_piece_size()
    numbered = aligned(df, id_col, text_col, a_path, b_path).withColumn("row", F.monotonically_increasing_id())
    found = saved(numbered, "alignment-texts")
    pair = F.explode(F.arrays_zip("keys", "times")).alias("p")
    each = found.select("row", pair).select("row", F.col("p.keys").alias("key"), F.col("p.times").alias("n"))
    counts = saved(each.groupBy("key").agg(F.sum("n").alias("count")), "alignment-counts")
    right = F.pmod("key", F.lit(b_size))
    highest = counts.groupBy(right.alias("b")).agg(F.max("count").alias("highest"))
    rated = saved(
        counts.withColumn("b", right).join(highest, "b").select("key", "count", (F.col("count") == F.col("highest")).alias("best")), "alignment-pairs")
    if rated.count() <= pairs_in_memory:
        rated = F.broadcast(rated)
    sums = each.join(rated, "key").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    kept = found.drop("keys", "times").join(sums, "row", "left")
    zero = F.lit(0).cast("long")
    return kept.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
