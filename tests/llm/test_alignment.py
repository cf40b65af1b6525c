"""Alignment against a plain walk over byte ranges."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import FOLDER
from exposura.llm import alignment, queries

SCHEMA = "doc_id long, text string, row string, KEY int, n_a int"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_letters():
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, extra = {}, 0
    for b in range(256):
        if b in plain:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


LETTERS = byte_letters()


def spans(pieces):
    out, at = [], 0
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def tokens_of(both, text):
    a, b = both
    if not text:
        return None
    x = a.encode(" " + text, add_special_tokens=False)
    y = b.encode(text)
    of_a = [bytes(LETTERS[c] for c in t) for t in x.tokens]
    of_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)]]
    data = (" " + text).encode()
    if b"".join(of_a) != data or b"".join(of_b) != data:
        return None
    return x.ids, y, spans(of_a), spans(of_b)


def brute(both, rows):
    coded = [(i, tokens_of(both, t)) for i, t in rows]
    links = []
    for _, c in coded:
        found = []
        if c:
            a, b, sa, sb = c
            for i, (s, e) in enumerate(sa):
                found += [(a[i], b[j]) for j, (u, v) in enumerate(sb) if max(s, u) < min(e, v)]
        links.append(found)
    count = Counter(p for found in links for p in found)
    highest = {}
    for (_, b), n in count.items():
        highest[b] = max(highest.get(b, 0), n)
    out = []
    for (id_, c), found in zip(coded, links):
        if not c:
            out.append((id_, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, sa, sb = c
        shared = sorted({e for _, e in sa} & {e for _, e in sb})
        parts, begin = [], 0
        for end in shared:
            parts.append(",".join(str(i) for i, (s, e) in zip(a, sa) if begin < e <= end) + "|" + ",".join(str(i) for i, (s, e) in zip(b, sb) if begin < e <= end))
            begin = end
        best = sum(count[p] == highest[p[1]] for p in found)
        out.append((id_, len(a), len(b), len(shared), len(found), best, sum(count[p] for p in found), hashlib.sha256(";".join(parts).encode()).hexdigest()))
    return out


def same(df, want):
    assert sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr) == sorted(want, key=repr)


def test_edges_and_both_ways_to_the_counts(spark, both):
    rng = random.Random(2)
    parts = ["hello", " world", "\n", "\t", "  ", "é", "中文", "😀", "<s>", "</s>", "<|endoftext|>", "▁", "123", "don't", "<0x0A>", "́", "ing", "ﬁ", "\r\n", "\x00", "﻿"]
    texts = [None, "", " ", "x", "hello", "▁", "a" * 500, "word " * 300] + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(80)]
    rows = [(k if k != 4 else None, t) for k, t in enumerate(texts)] + [(8, texts[8])] * 2 + [(3, "other")]
    df = spark.createDataFrame([(i, t, "r", 1, 2) for i, t in rows], SCHEMA).repartition(3)
    want = brute(both, rows)
    same(alignment.align(df), want)
    same(alignment.align(df, pairs_in_memory=0), want)
    assert alignment.align(spark.createDataFrame([], SCHEMA)).count() == 0


def test_groups_by_pointer_jumping():
    rng = random.Random(4)
    for _ in range(300):
        total = rng.randrange(1, 60)
        a_end = np.array(sorted({*rng.sample(range(1, total + 1), rng.randrange(total)), total}))
        b_end = np.array(sorted({*rng.sample(range(1, total + 1), rng.randrange(total)), total}))
        shared = np.intersect1d(a_end, b_end)
        a_group, b_group = alignment.groups_of(a_end, b_end)
        assert a_group.tolist() == np.searchsorted(shared, a_end).tolist()
        assert b_group.tolist() == np.searchsorted(shared, b_end).tolist()


def test_long_chain_settles():
    """Ends that never meet before the last one: one group of 200,001 tokens."""
    a_end = np.append(np.arange(2, 200_001, 2), 200_001)
    b_end = np.append(np.arange(1, 200_001, 2), 200_001)
    b_end = np.unique(b_end)
    a_group, b_group = alignment.groups_of(a_end, b_end)
    assert set(a_group) == set(b_group) == {0}


def test_registered_query(spark, both):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = [tuple(r) for r in docs if len(r["text"] or "") < 3000]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    same(alignment.align(df), brute(both, rows))
    whole = queries.queries()["op13_alignment"](spark, FOLDER)
    assert sorted(whole.columns) == sorted(COLUMNS) and whole.count() == len(docs)


def test_ranks_equal_the_library(both):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as a, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as b:
        tok = alignment.Tokenizers(a.read(), b.read())
    rng = random.Random(6)
    parts = ["hello", " world", "\n", "  ", "é", "中文", "😀", "<|endoftext|>", "123", "don't", "'LL", "\x1c", " ", "́", "ing", "a" * 300, " " * 70, "==="]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(500)] + ["x" * 30_000, " " * 30_000, "".join(map(chr, range(1, 0x3000)))]
    assert tok.ranks is not None
    for text in texts:
        assert tok.left(" " + text) == both[0].encode(" " + text, add_special_tokens=False).ids
