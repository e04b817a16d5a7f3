import random

import pytest
from helpers import rows_of, table, text_of
from pyspark.sql import functions as F
from test_near_dedup import brute, chains

from lakeops.sinks.staging import Staging
from llm import near_dedup, slots
from llm.near_dedup import near_duplicates
from llm.slots import perhaps_in


@pytest.fixture
def no_broadcast(spark):
    """Tables are too large to broadcast unless asked for."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffled_rows(plan):
    """The most rows that one exchange of an executed plan wrote."""
    found, todo = [0], [plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        else:
            if node.nodeName() == "Exchange":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            todo.extend(node.children().apply(i) for i in range(node.children().size()))
    return max(found)


def test_texts_and_buckets_without_a_partner_are_not_shuffled(spark, monkeypatch, no_broadcast):
    rows = [(i, text_of(i, 40, 4000), "en", "a", 1) for i in range(600)]
    rows += [(1000 + i, rows[i][1] + " end", "en", "a", 1) for i in range(0, 20, 2)]
    most, counts = {}, {}

    class Watching(Staging):
        def __call__(self, df, name):
            out = super().__call__(df, name)
            if name in ("sets", "members"):
                again = df.select("*")
                again.collect()
                most[name] = shuffled_rows(again._jdf.queryExecution().executedPlan())
            counts.update(self.rows)
            return out

    monkeypatch.setattr(near_dedup, "Staging", Watching)
    found = rows_of(near_duplicates(table(spark, rows)))
    linked = {r[0] for r in found if not r[3]}
    assert {1000 + i for i in range(0, 20, 2)} <= linked
    # 610 texts and 42 or more bucket rows of each.
    assert 20 <= counts["needed"] <= most["sets"] < 150
    assert counts["members"] <= most["members"] < 5000


@pytest.mark.parametrize("most", [64, 1 << 26])
def test_all_wanted_pass_and_few_others(spark, monkeypatch, most):
    monkeypatch.setattr(slots, "MOST_SLOTS", most)
    rows = spark.range(-5000, 5000).select(F.when(F.col("id") != 7, F.col("id")).alias("id"), (F.col("id") % 2 == 0).alias("even"))
    rows = rows.unionByName(rows.where("id > 4990"))
    keys = random.Random(1).sample(range(-5000, 5000), 300)
    wanted = rows.where(F.col("id").isin(keys) | F.col("id").isNull()).distinct()
    passed = perhaps_in(rows, ("id", "even"), wanted, wanted.count())
    assert passed.columns == rows.columns
    inside = rows.where(F.col("id").isin(keys) | F.col("id").isNull())
    assert inside.exceptAll(passed).count() == 0
    assert passed.exceptAll(rows).count() == 0
    if most > 64:
        assert passed.count() < inside.count() + 600  # one in 32


def test_no_wanted_keys(spark):
    rows = spark.range(10)
    assert perhaps_in(rows, ("id",), rows.where("id < 0"), 0).count() == 0


def test_few_slots_give_the_same_components(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(slots, "MOST_SLOTS", 64)
    rows = chains(4, 12)
    assert rows_of(near_duplicates(table(spark, rows))) == brute(rows)
