"""Recordings hold whole actions, and what the queries do with them is right on whole actions too: and so does their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from termloom.plans import inputs as i, registry

SHOWN = ["line_segmentation", "prompt_context", "observation_recovery", "command_match_ratio", "ansi_clean", "prompt_json", "cast_roundtrip_v2", "cast_roundtrip_v3"]


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql(f"create view conversations as from '{sf}/conversations.parquet'")
    return con


def test_recordings_hold_whole_actions(spark, sf):
    actions = [r.action for r in i.conversation_turns(spark, sf).select(F.concat(F.lit("echo "), F.trim(F.regexp_replace(F.lower("action"), "[^a-z0-9]+", " "))).alias("action")).collect()]
    assert sum(len(a) > 65 for a in actions) > 20
    for version in (1, 2, 3):
        text = "\n".join(r.text for r in i.synthetic_casts(spark, sf, version).select("text").collect())
        assert all(a in text for a in actions if a != "echo ")


@pytest.mark.parametrize("name", SHOWN)
def test_whole_actions(name, spark, sf, duck, tmp_path):
    assert "substr" not in i.WHOLE_SQL
    registry.QUERIES[name](spark, sf, i.whole_turns).write.parquet(f"{tmp_path}/out")
    found = f"'{tmp_path}/out/*.parquet'"
    columns = ", ".join(f'"{c}"' for c in sorted(duck.sql(f"from {found}").columns))
    a, b = f"select {columns} from {found}", f"select {columns} from ({registry.ORACLE_SQL[name]})"
    assert duck.sql(f"({a}) except all ({b})").fetchall() == [] == duck.sql(f"({b}) except all ({a})").fetchall()


def test_version_1_takes_whole_actions(spark, sf):
    """Version 1 infers commands from output, and takes a line of over 200 characters for output."""
    expected = [(r.file_id, r.action) for r in i.whole_turns(spark, sf).orderBy("file_id", "turn_id").collect() if len(r.action) <= 200]
    found = registry.QUERIES["cast_roundtrip_v1"](spark, sf, i.whole_turns).orderBy("file_id", "turn_id").collect()
    assert any(len(a) > 65 for _, a in expected) and [(r.file_id, r.action) for r in found] == expected
