"""Plan shape: the rows of a scan pass are never shuffled again after materialization."""

import re

from wickworks.operators.indicators import indicators
from wickworks.plans import inputs


def _indent(line: str) -> int:
    m = re.search(r"[+:]-|\*\(", line)
    return m.start() if m else len(line) - len(line.lstrip())


def _row_shuffles(plan: str) -> list[str]:
    lines = plan.splitlines()
    bad = []
    for i, line in enumerate(lines):
        if "Exchange" not in line:
            continue
        d = _indent(line)
        for sub in lines[i + 1:]:
            if _indent(sub) <= d:
                break
            if "Exchange" in sub:
                break
            if "FileScan" in sub and "wickworks_scan" in sub and "open#" in sub:
                bad.append(line.strip()[:120])
                break
    return bad


def test_gold_rows_not_reshuffled(spark):
    df = indicators(inputs.candles(spark, "/root/testdata/sf0.001"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "wickworks_scan" in plan
    assert _row_shuffles(plan) == []
    assert "SinglePartition" not in plan


def test_pass_table_is_read_twice_whatever_the_depth(spark):
    """Block states are read off the rows once, and written if several fold levels need them."""
    from wickworks.operators.scan import FoldPlan, add_blocks, exclusive_carries, materialize

    rows = spark.range(4000).selectExpr(
        "timestamp_millis(1704067200000 + id * 60000) AS event_time", "'1m' AS timeframe", "'s' AS symbol", "CAST(id AS DOUBLE) AS x"
    )
    blocked, _ = materialize(add_blocks(rows, ["symbol", "timeframe"], ["event_time"], block_rows=16), ["symbol", "timeframe"])
    elems = blocked.groupBy("symbol", "timeframe", "_bucket", "_sub").sum("x").withColumnRenamed("sum(x)", "s").selectExpr("symbol", "timeframe", "_bucket", "_sub", "struct(s) AS st")
    for levels in (1, 2, 3):
        carries = exclusive_carries(elems, ["symbol", "timeframe"], "st", lambda a, b: f"named_struct('s', {a}.s + {b}.s)", FoldPlan(levels, 64))
        plan = carries._jdf.queryExecution().executedPlan().toString()
        scans, states = plan.count("Scan parquet spark_catalog.default.wickworks_scan_"), plan.count("states-")
        assert (scans, states > 0) == ((1, False) if levels == 1 else (0, True)), plan
        assert carries.count() == elems.count()


def test_pass_tables_can_be_released(spark):
    from wickworks.operators.indicators import row_index
    from wickworks.operators.scan import PASS_TABLE, release

    rows = spark.sql("SELECT timestamp'2024-01-01' AS event_time, 'a' AS symbol, '1h' AS timeframe, 's' AS source, 1D AS close")
    assert row_index(rows).count() == 1
    assert release(spark) > 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(PASS_TABLE)] and release(spark) == 0
