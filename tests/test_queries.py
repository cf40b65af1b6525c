"""Every registered query against its SQL, and what no result or plan may hold."""

import re

import pytest

from conftest import in_name_order
from exposura import catalog, rules

NAMES = sorted(catalog.queries())
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(name, results, duck):
    columns, rows, _, types = results(name)
    cur = duck.execute(catalog.oracles()[name])
    expected_columns = [d[0] for d in cur.description]
    sql_types = {d[0]: str(d[1]) for d in cur.description}
    assert sorted(columns) == sorted(expected_columns)
    assert {c: TYPES.get(types[c], types[c]) for c in columns} == sql_types
    assert in_name_order(columns, rows) == in_name_order(expected_columns, cur.fetchall())


@pytest.mark.parametrize("name", NAMES)
def test_no_cross_join_and_no_python_in_plan(name, results):
    plan = results(name)[2]
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan, word


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d)
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _sensitive(column, value):
    """Tokens of personal data or secrets in a value; digests are named as such."""
    found = re.findall(rules.EMAIL, value) + re.findall(rules.IPV4, value)
    found += [t for t in re.findall(rules.PHONE, value) if 7 <= len(re.sub(r"\D", "", t)) <= 15]
    if not column.endswith("_hash"):
        found += re.findall(rules.KEY, value)
        found += [t for t in re.findall(rules.CARD, value) if _luhn(re.sub(r"\D", "", t))]
    return found


@pytest.mark.parametrize("name", NAMES)
def test_no_output_carries_personal_data(name, results):
    columns, rows, _, _ = results(name)
    for i, column in enumerate(columns):
        for row in rows:
            if isinstance(row[i], str):
                assert not _sensitive(column, row[i]), column


def test_the_tables_do_hold_personal_data(duck):
    n = duck.execute(f"SELECT count(*) FROM documents WHERE regexp_matches(text, '{rules.EMAIL}')").fetchall()
    assert n[0][0] >= 0
    text = "\n".join(r[0] for r in duck.execute("SELECT text FROM documents").fetchall())
    assert _sensitive("text", text)


def test_every_query_has_sql():
    assert sorted(catalog.oracles()) == NAMES
