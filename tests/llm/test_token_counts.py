"""Token counts of the transducer against the tokenizer's library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from exposura.llm import queries, transducer

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["'", "s", "t", "r", "e", "v", "l", "m", "d", " ", "\n", "a", "B", "É", "é", "Σ", "ΑΣ", "İ", "ß", "1", "²", "½", "中", "文", "!", "?", "-",
         "<|startoftext|>", "<|endoftext|>", "<|", "😀", "́", "가", "가", "\x1c", "᠎", "_", "hello", "THE", "ing", " ", "Å", "ﬁ", "Ɤ", "ͅ"]
SCHEMA = "doc_id long, text string, Text_ int, row string, CHUNK int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def machine():
    return transducer.Transducer(transducer.read_rules(PATH))


def expected(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def random_texts(n, longest=40, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(longest))) for _ in range(n)]


def test_equals_the_library_whole_and_in_chunks(library, machine):
    rng = random.Random(5)
    for text in random_texts(3000):
        want = expected(library, text)
        assert machine.count(text) == want, text
        parts = transducer.cuts(text, rng.randrange(1, 9), machine.special)
        assert "".join(parts) == text
        assert machine.applied(machine.composed([machine.chunk_map(p) for p in parts])) == want, (text, parts)


def test_every_character_of_the_first_plane(library, machine):
    for code in range(0x110, 0x10000, 7):
        if not 0xD800 <= code < 0xE000:
            text = f"ab{chr(code)}cd'{chr(code)}s 1"
            assert machine.count(text) == expected(library, text), hex(code)


def test_composition_is_associative(machine):
    for text in random_texts(200, 60, 9):
        maps = [machine.chunk_map(p) for p in transducer.cuts(text, 5, machine.special)]
        if len(maps) >= 3:
            left = machine.composed([machine.composed(maps[:2]), *maps[2:]])
            right = machine.composed([maps[0], machine.composed(maps[1:])])
            assert left == right


def test_states_are_dropped_and_compiled_again(library, machine, monkeypatch):
    monkeypatch.setattr(transducer, "KEPT_STATES", 50)
    for text in random_texts(200, 30, 13):
        assert machine.count(text) == expected(library, text)
    assert len(machine.states) < 1000


def test_long_word_without_any_break(library, machine):
    text = "abcdefgh" * 5000
    maps = [machine.chunk_map(p) for p in transducer.cuts(text, 1000, machine.special)]
    assert machine.applied(machine.composed(maps)) == machine.count(text) == expected(library, text)


def test_edges_on_spark(spark, library):
    texts = [None, "", " \n", "Don't <|endoftext|> stop", "x" * 300, "a b " * 500, "Don't <|endoftext|> stop", *random_texts(40, 200, 21)]
    rows = [(k if k != 2 else None, t, 1, "r", 2) for k, t in enumerate(texts)] + [(3, texts[3], 1, "r", 2)] * 2 + [(5, texts[5], 1, "r", 2)] * 2
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(map(tuple, transducer.count_tokens(df, chunk=50).collect()), key=repr)
    want = sorted(((i, len((t or "").encode()), expected(library, t)) for i, t, *_ in rows), key=repr)
    assert got == want
    assert transducer.count_tokens(spark.createDataFrame([], SCHEMA)).count() == 0


def test_registered_query(spark, library):
    from conftest import FOLDER

    rows = queries.queries()["op11_token_counts"](spark, FOLDER).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = expected(library, texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((texts[r["doc_id"]] or "").encode()), n, n > 2048)
