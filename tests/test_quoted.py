"""Quoted records and JSON arrays over many small splits, against readers that see a whole file."""

import csv
import json
import random

import pytest
from pyspark.sql import types as T

from exposura.sources import quoted, readers


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


CELLS = ["a", "", '5" pipe', 'say "hi"', "x,y", "line\nbreak", '"', "end\r\nx", '""q,\n\n"', "é", " b ", ",\n,", '"\n"']


def written(path, rows, header=True, ends="\n"):
    def cell(v):
        return '"' + v.replace('"', '""') + '"' if any(x in v for x in ",\n\r") or v.startswith('"') else v

    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(("id,a,b,c" + ends) * header + "".join(",".join(map(cell, r)) + ends for r in rows))


def plain(rows):
    return sorted(tuple(x or "" for x in r) for r in rows)


@pytest.mark.parametrize("seed, ends", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_one_file_in_many_splits_equals_a_whole_read(small_splits, tmp_path, seed, ends):
    rng = random.Random(seed)
    for k in range(2):
        written(tmp_path / f"{k}.csv", [[f"{k}-{n}"] + [rng.choice(CELLS) for _ in range(3)] for n in range(120)], ends=ends)
    got = readers.read_delimited(small_splits, str(tmp_path), columns=["id", "a", "b", "c"])
    assert quoted.split_lines(small_splits, str(tmp_path)).rdd.getNumPartitions() > 8
    want = [r for k in range(2) for r in list(csv.reader(open(tmp_path / f"{k}.csv", newline="", encoding="utf-8")))[1:]]
    assert plain(got.collect()) == plain(want)
    if ends == "\r\n":  # the whole-file reader turns these into \n within quotes
        return
    whole = small_splits.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(tmp_path))
    assert plain(got.collect()) == plain(whole.collect())
    assert readers.read_delimited(small_splits, str(tmp_path)).columns == ["id", "a", "b", "c"]


def test_a_record_over_many_splits_and_one_never_closed(small_splits, tmp_path):
    long = "\n".join(f"line {k}" for k in range(200))
    (tmp_path / "a.csv").write_text(f'id,a,b,c\n1,"{long}",x,y\n2,b,c,d\n3,"open\nrest\n')
    rows = readers.read_delimited(small_splits, str(tmp_path), columns=["id", "a", "b", "c"]).collect()
    found = {r["id"]: r for r in rows}
    assert found["1"]["a"] == long and found["2"]["b"] == "c" and len(rows) == 3


def test_ragged_headerless_and_positional(small_splits, tmp_path):
    (tmp_path / "a.csv").write_text('1,"x\ny"\n\n2,b,c,d,e\n3,f,g\n')
    assert plain(readers.read_headerless_generic(small_splits, str(tmp_path)).collect()) == [("1", "x\ny"), ("2", "b"), ("3", "f")]
    got = readers.read_positional(small_splits, str(tmp_path), {0: "id", 2: "c", 9: "beyond"}).collect()
    assert plain(got) == [("1", "", ""), ("2", "c", ""), ("3", "g", "")]


def test_the_states_of_lines_are_those_of_a_walk(spark, one):
    """open_quote against a character walk, from either state."""
    rng = random.Random(8)
    lines = ["".join(rng.choice(['"', ",", "a", '""', " "]) for _ in range(rng.randrange(12))) for _ in range(600)]

    def walk(line, inside):
        k, begin = 0, not inside
        while k < len(line):
            ch = line[k]
            if inside:
                if ch == '"':
                    if line[k + 1:k + 2] == '"':
                        k += 1
                    else:
                        inside = False
                begin = False
            elif ch == '"' and begin:
                inside = True
            else:
                begin = ch == ","
            k += 1
        return inside

    df = spark.createDataFrame([(x,) for x in lines], "line string")
    got = df.select("line", *[quoted.open_quote(df.line, ",", k).alias(f"s{int(k)}") for k in (False, True)]).collect()
    for r in got:
        assert (r["s0"], r["s1"]) == (walk(r["line"], False), walk(r["line"], True)), r["line"]


def schema():
    return T.StructType.fromDDL("id long, a string, b struct<x:string,y:array<struct<z:string>>>")


@pytest.mark.parametrize("seed", [1, 2])
def test_json_arrays_in_many_splits(small_splits, tmp_path, seed):
    rng = random.Random(seed)
    words = ["a", "", "},{", ',"', "\\", '\\"}', "[[", "x\ny", "é}", "{", "]"]
    want = []
    for f in range(2):
        rows = [{"id": k, "a": rng.choice(words), "b": {"x": rng.choice(words), "y": [{"z": rng.choice(words)} for _ in range(rng.randrange(3))]}}
                if rng.random() < 0.9 else {} for k in range(80)]
        want += rows
        (tmp_path / f"{f}.json").write_text(json.dumps(rows, indent=[None, 1][f], ensure_ascii=False) + "\n")
    assert quoted.split_lines(small_splits, str(tmp_path), "}").rdd.getNumPartitions() > 8
    got = readers.read_json_array(small_splits, str(tmp_path), schema()).collect()

    def row(r):
        return r.get("id"), r.get("a"), "b" in r and (r["b"]["x"], tuple(z["z"] for z in r["b"]["y"]))

    found = [(r["id"], r["a"], r["b"] is not None and (r["b"]["x"], tuple(z["z"] for z in r["b"]["y"]))) for r in got]
    assert sorted(found, key=repr) == sorted(map(row, want), key=repr)


def test_json_array_edges(spark, tmp_path):
    (tmp_path / "a.json").write_text(' [1, "x{", {"id": 1}, null, {"id": 2, "a": }, {"id": 3, "a": "b"}]\n')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text("")
    assert sorted(r["id"] for r in readers.read_json_array(spark, str(tmp_path), schema()).collect()) == [1, 3]
