"""Plan invariants over every binding (scale guards)."""

import re

import pytest

from pyspark.sql import functions as F

from chunkwise.operators import ledger
from chunkwise.plans import QUERIES
from chunkwise.plans.explain import SKIP
from chunkwise.plans.tables import ntz, table

from conftest import SF_SMALL


def _single_partition_children(plan: str) -> list[str]:
    """The operator directly below each ``Exchange SinglePartition``."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) > depth:
                    out.append(re.sub(r"^[\s:+\-*()0-9]+", "", nxt))
                    break
    return out


@pytest.mark.parametrize("key", sorted(k for k in QUERIES if k not in SKIP))
def test_single_partition_exchanges_move_only_aggregates(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for child in _single_partition_children(plan):
        assert child.startswith(("HashAggregate", "SortAggregate", "ObjectHashAggregate")), \
            (key, child)
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key,column", [("roc_auc", "_cw_group"), ("stratified_split", "quality"),
                                        ("stratified_folds", "quality"),
                                        ("fit_scope_train", "quality")])
def test_rows_are_not_shuffled_on_a_few_values(spark, key, column):
    """An exchange on the class column moves partial aggregates only."""
    lines = _final_plan(QUERIES[key](spark, SF_SMALL)).split("== Initial Plan ==")[0].splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(" in line and (column in line or "coalesce" in line):
            below = "".join(lines[i + 1:i + 5])
            assert "partial_" in below, (key, line, below)
    assert not any("SortMergeJoin" in x for x in lines)


@pytest.mark.parametrize("make", [
    lambda t: ledger.delete_where(t("orders"), F.col("o_orderpriority") == "5-LOW",
                                  ["o_orderpriority"]),
    lambda t: ledger.retained(t("events"), "ts", ledger.retention_cutoff(ntz("2024-02-15 00:00:00"))),
    lambda t: ledger.health_stats(t("part"), "p_name", t("events"), "ts", t("orders"), "o_orderstatus",
                                  as_of=ntz("2024-01-30 12:00:00"), pending="P")])
def test_predicates_reach_the_scan(spark, make):
    plan = _final_plan(make(lambda n: table(spark, SF_SMALL, n))).split("== Initial Plan ==")[0]
    pushed = re.findall(r"PushedFilters: \[([^\]]*)", plan)
    assert pushed and all(pushed), plan


def test_one_scan_validates_and_splits(spark):
    from chunkwise.operators import validate
    from chunkwise.functions import one_of
    from chunkwise.session import scratch_path
    checked = validate.with_errors(table(spark, SF_SMALL, "orders"), [one_of("o_orderstatus", ("O", "F"))])
    assert checked._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    paths = validate.write_split(checked, scratch_path(spark, "split"))
    n = sum(spark.read.parquet(p).count() for p in paths.values())
    assert n == table(spark, SF_SMALL, "orders").count()


def test_positions_read_the_input_at_most_twice(spark):
    """Once to sample range bounds, once to shuffle; not for quantiles or counts."""
    from chunkwise.operators import chunks
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.range(0, 5000, numPartitions=4).mapInArrow(count, "id long")
    assert chunks.assign_chunks(df, ["id"], 500).count() == 5000
    assert reads.value <= 2 * 5000
