"""Queries whose rows must show both outcomes: a twin that agrees on rows without any finding says little."""

import pytest
from conftest import SF001
from oracle_check import compare, duck

from __spark_entry__ import oracle_sql, queries
from tessera.operators.context import NO_WEB, URL_PLACEHOLDER
from tessera.operators.guard import CLOSE_TAG_ESCAPED, SECURITY_NOTICE

# query -> what tells its two outcomes apart
OUTCOMES = {
    "injection_flags": lambda r: r.n_flags > 0,
    "wrap_output": lambda r: SECURITY_NOTICE in r.wrapped and CLOSE_TAG_ESCAPED in r.wrapped,
    "source_context": lambda r: URL_PLACEHOLDER in r.context,
    "frontmatter": lambda r: r.changed and r.n_meta == 2,
    "code_blocks": lambda r: r.code is not None and r.code.startswith("print("),
    "fetch_plan": lambda r: r.status == "hit",
    "trace_judge": lambda r: bool(r.citation_ok),
    "curated_subset": lambda r: r.status == "found",
    "request_gate": lambda r: r.verdict == "blocked",
    "web_context": lambda r: r.block == NO_WEB,
}
ONE_OUTCOME = ["judge_first", "mix_check", "item_limits", "tool_sequence", "chat_view"]


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", [*OUTCOMES, *ONE_OUTCOME])
def test_twin_agrees_and_both_outcomes_occur(spark, con, name):
    df = queries()[name](spark, SF001)
    rows = df.collect()
    cur = con.execute(oracle_sql()[name])
    found, columns = cur.fetchall(), [d[0] for d in cur.description]
    assert not compare([tuple(r) for r in rows], df.columns, found, columns)
    assert rows
    if name in OUTCOMES:
        assert {bool(OUTCOMES[name](r)) for r in rows} == {True, False}


def test_quota_reaches_every_branch(spark):
    rows = {r.n: (r.factual, r.howto, r.compare) for r in queries()["quota_check"](spark, SF001).collect() if r.source_path.startswith("quota/")}
    assert set(rows) == set(range(1, 16))
    assert rows[1] == (0, 1, 0) and rows[2] == (1, 1, 0) and rows[3] == (1, 1, 1)
