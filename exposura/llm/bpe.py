"""Byte-level BPE by prefix dynamic programming."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_PIECES = 400_000
CACHED_PREFIXES = 800_000
LONG_PIECE = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks of byte strings, and how each token is built from two smaller ones."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = dict(zip(ranks.values(), ranks.keys()))
        self.length = {rank: len(token) for token, rank in ranks.items()}
        self.longest = max(self.length.values())
        self.halves: dict[int, tuple[int, int]] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def split(self, rank: int) -> tuple[int, int] | None:
        """The two tokens of the last merge that makes this token; None for a byte."""
        found = self.halves.get(rank, 0)
        if found == 0:
            parts = [bytes([b]) for b in self.token[rank]]
            while len(parts) > 2:
                at = min(range(len(parts) - 1), key=lambda k: self.ranks.get(parts[k] + parts[k + 1], 1 << 60))
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            found = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
            self.halves[rank] = found
        return found

    def together(self, left: int, right: int) -> bool:
        """Whether BPE of the two tokens' bytes gives these two tokens.

        Undoes merges from the higher rank down. If at any point the tokens at the
        border would have merged before the merge just undone, the border moves.
        """
        known = self.fits.get((left, right))
        if known is None:
            known = self._border_holds(left, right)
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            self.fits[left, right] = known
        return known

    def _border_holds(self, a: int, b: int) -> bool:
        limit = 1 << 60
        while True:
            joined = self.ranks.get(self.token[a] + self.token[b])
            if joined is not None and joined < limit:
                return False
            halves_a, halves_b = self.split(a), self.split(b)
            if halves_a is None and halves_b is None:
                return True
            if halves_b is None or (halves_a is not None and a > b):
                limit, a = a, halves_a[1]
            else:
                limit, b = b + 1, halves_b[0]


class PrefixEncoder:
    """The encoding of a growing piece: for each of its prefixes, the last token.

    Exactly one token that ends at a position goes with the encoding before it, so
    one number per byte holds the encodings of all prefixes. Appending extends the
    list; cutting shortens it, and what is left is already encoded.
    """

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.v, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        v, last = self.v, self.last
        find, fits, together, longest = v.ranks.get, v.fits.get, v.together, v.longest
        start, self.piece = len(self.piece), self.piece + more
        piece = self.piece
        for end in range(start + 1, len(piece) + 1):
            for begin in range(end - longest if end > longest else 0, end):
                token = find(piece[begin:end])
                if token is None:
                    continue
                if begin:
                    before = last[begin - 1]
                    fit = fits((before, token))
                    if fit is None:
                        fit = together(before, token)
                    if not fit:
                        continue
                last.append(token)
                break

    def replace(self, begin: int, end: int, new: bytes) -> None:
        """Swaps piece[begin:end]; the prefixes before it keep their tokens."""
        tail = self.piece[end:]
        self.piece, self.last = self.piece[:begin], self.last[:begin]
        self.append(new + tail)

    def ids(self, end: int | None = None) -> list[int]:
        """The encoding of the first `end` bytes, all by default."""
        at = len(self.piece) if end is None else end
        out = []
        while at:
            out.append(self.last[at - 1])
            at -= len(self.v.token[out[-1]])
        return out[::-1]


class Pieces(dict):
    """Encodings of the pieces met so far; a new one is encoded when asked for.

    Pieces share their beginnings, so the last tokens are kept by the bytes of the
    prefix: a new piece costs only the prefixes no earlier piece had.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary
        self.last: dict[bytes, int] = {}

    def trim(self) -> None:
        if len(self) > CACHED_PIECES:
            self.clear()
        if len(self.last) > CACHED_PREFIXES:
            self.last.clear()

    def __missing__(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.v.ranks.get(data)
        if whole is not None:
            found = (whole,)
        elif len(data) > LONG_PIECE:
            found = tuple(PrefixEncoder(self.v, data).ids())
        else:
            found = self._by_prefixes(data)
        self[piece] = found
        return found

    def _by_prefixes(self, data: bytes) -> tuple[int, ...]:
        v, last = self.v, self.last
        find, fits, together = v.ranks.get, v.fits.get, v.together
        known = size = len(data)
        while known and data[:known] not in last:
            known -= 1
        for end in range(known + 1, size + 1):
            for begin in range(end):
                token = find(data[begin:end])
                if token is None:
                    continue
                if begin:
                    before = last[data[:begin]]
                    fit = fits((before, token))
                    if fit is None:
                        fit = together(before, token)
                    if not fit:
                        continue
                last[data[:end]] = token
                break
        out = []
        while size:
            token = last[data[:size]]
            out.append(token)
            size -= v.length[token]
        return tuple(out[::-1])


class Codec:
    """Whole texts to ids and back; tables that are full are emptied."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.v = Vocabulary(ranks)
        self.pieces = regex.compile(pattern)
        self.seen = Pieces(self.v)

    def encode(self, text: str) -> list[int]:
        self.seen.trim()
        return list(chain.from_iterable(map(self.seen.__getitem__, self.pieces.findall(text))))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.v.token.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def _codec(name: str, ranks: dict[bytes, int], pattern: str) -> Codec:
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = Codec(ranks, pattern)
    return _codecs[name]


ENCODED = "doc_id long, ids array<int>, decoded binary"


def _source(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def _mapper(df: DataFrame, path: str | None, pattern: str | None, shape):
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern = pattern or public_tokenizers.PATTERN
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(f"{path} {pattern}", ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield shape(codec, part.column(0), part.column(1))

    return run


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Rows doc_id, ids, decoded: the ids of each whole text and the bytes they stand for.

    Every match of the pattern is encoded by itself, without special tokens. A null
    text counts as empty and gives no ids; rows are independent, so repeated rows
    repeat; other columns are not read. The vocabulary, a file of fixed size, is
    broadcast. No shuffle.
    """
    def shape(codec, ids, texts):
        coded = [codec.encode(t.as_py()) for t in texts]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(coded, pa.list_(pa.int32())), pa.array([codec.decode(c) for c in coded], pa.binary())], ["doc_id", "ids", "decoded"])

    return _source(df, id_col, text_col).mapInArrow(_mapper(df, path, pattern, shape), ENCODED)


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """As `encode`, with counts and digests in place of ids and bytes: doc_id, n_tokens,
    ids_sha256, decoded_sha256; what leaves the task is small."""
    decimal: dict[int, str] = {}

    def shape(codec, ids, texts):
        decimals = decimal or decimal.update((i, str(i)) for i in codec.v.token) or decimal
        n, of_ids, of_bytes = [], [], []
        for text in texts:
            coded = codec.encode(text.as_py())
            n.append(len(coded))
            of_ids.append(hashlib.sha256(" ".join(map(decimals.__getitem__, coded)).encode()).hexdigest())
            of_bytes.append(hashlib.sha256(codec.decode(coded)).hexdigest())
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(np.array(n, np.int64)), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _source(df, id_col, text_col).mapInArrow(
        _mapper(df, path, pattern, shape), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
