"""Column functions against plain Python over generated texts."""

import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from exposura import rules
from exposura.functions import lines, sensitive, text
from exposura.operators import windows

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
WORDS = st.lists(st.sampled_from(
    ["leak", "data leak", "Data", "LEAKED", "combo", "list", "x", " ", "\n", "=", "a@example.com", "192.0.2.7", "é", "dump", "sql"]
), max_size=25).map("".join)


@SETTINGS
@given(texts=st.lists(WORDS, min_size=1, max_size=30))
def test_keywords_are_those_contained(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: r.m for r in df.select("id", text.matched_words(F.col("t"), rules.KEYWORDS).alias("m")).collect()}
    assert got == {i: [k for k in rules.KEYWORDS if k in t.lower()] for i, t in enumerate(texts)}


@SETTINGS
@given(texts=st.lists(WORDS, min_size=1, max_size=30))
def test_redacted_texts_hold_no_address(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select(sensitive.redact(F.col("t")).alias("r")).collect():
        assert not re.search(rules.EMAIL, r.r) and not re.search(rules.IPV4, r.r)


LINES = st.lists(st.text(alphabet="ab =-#:~. ", max_size=16), max_size=12).map("\n".join)


@SETTINGS
@given(texts=st.lists(LINES, min_size=1, max_size=30), ratio=st.sampled_from([0.25, 0.5, 0.8, 0.95]))
def test_symbol_lines_are_those_counted(spark, texts, ratio):
    def crowded(line):
        s = line.strip()
        return len(s) > 10 and sum(c in "\\/|_=-#*+`~:. " for c in s) / len(s) > ratio

    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    got = {r.id: r.k for r in df.select("id", lines.drop_symbol_lines(F.col("t"), ratio).alias("k")).collect()}
    assert got == {i: "\n".join(x for x in t.split("\n") if not crowded(x)) for i, t in enumerate(texts)}


@SETTINGS
@given(data=st.lists(st.tuples(st.sampled_from("hhhhab"), st.booleans()), min_size=1, max_size=60))
def test_blocks_count_their_starts(spark, data):
    seen, want = {}, {}
    for i, (k, start) in enumerate(data):
        seen[k] = seen.get(k, 0) + start
        want[i] = seen[k]
    df = spark.createDataFrame([(i, k, s) for i, (k, s) in enumerate(data)], "id int, k string, s boolean")
    got = windows.block_numbers(df, "k", ["id"], F.col("s")).collect()
    assert {r.id: r.block_id for r in got} == want
