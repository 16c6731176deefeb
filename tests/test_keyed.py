"""Tables that are loaded in increments."""

from pathlib import Path

import pytest

from tidemark.operators.keyed import KeyedTable

SCHEMA = "job_key long, title string, source string"


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def held(table):
    return sorted(map(tuple, table.read().collect()))


@pytest.fixture
def table(spark, tmp_path):
    name = f"keyed_{tmp_path.name.replace('-', '_')}"
    made = KeyedTable.create(spark, name, rows(spark), ["source", "job_key"], "source", str(tmp_path / "t"), buckets=4)
    yield made
    spark.sql(f"DROP TABLE {name}")


def files(tmp_path, source):
    return sorted((p.name, p.stat().st_mtime_ns) for p in Path(tmp_path, "t", f"source={source}").glob("*.parquet"))


def test_only_touched_partitions_are_rewritten(spark, table, tmp_path):
    table.insert_ignore(rows(spark, *[(i, f"t{i}", s) for i in range(20) for s in "ab"]))
    before = files(tmp_path, "b")
    table.upsert(rows(spark, (3, "new", "a"), (99, "more", "a"), (1, "first", "c")))
    assert files(tmp_path, "b") == before and before
    want = [(i, f"t{i}", s) for i in range(20) for s in "ab" if (i, s) != (3, "a")] + [(3, "new", "a"), (99, "more", "a"), (1, "first", "c")]
    assert held(table) == sorted(want)
    table.upsert(rows(spark, (3, "new", "a")))  # again: nothing changes
    assert held(table) == sorted(want)
    table.replace_partitions(rows(spark, (5, "only", "a")))
    assert held(table) == sorted([r for r in want if r[2] != "a"] + [(5, "only", "a")])
    table.upsert(rows(spark))
    assert len(held(table)) == 22


def test_new_rows_are_added_once(spark, table):
    batch = rows(spark, (1, "x", "a"), (1, "y", "a"), (2, "z", "b"))
    table.insert_ignore(batch)
    assert [r[0::2] for r in held(table)] == [(1, "a"), (2, "b")]
    table.insert_ignore(batch.union(rows(spark, (3, "w", "b"))))
    assert [r[0::2] for r in held(table)] == [(1, "a"), (2, "b"), (3, "b")]


def test_the_old_side_is_not_shuffled(spark, table):
    table.insert_ignore(rows(spark, *[(i, f"t{i}", s) for i in range(50) for s in "ab"]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = rows(spark, (3, "new", "a"))
        for planned in (table.merged(batch), table.fresh(batch)):
            plan = planned._jdf.queryExecution().executedPlan().toString().splitlines()
            at = next(i for i, line in enumerate(plan) if "FileScan" in line)
            depth = lambda line: len(line) - len(line.lstrip(" :+-"))
            above, over = [], depth(plan[at])
            for line in reversed(plan[:at]):  # the operators that the scan feeds, up to the join
                if depth(line) < over:
                    above.append(line)
                    over = depth(line)
                if "Join" in line and line in above:
                    break
            assert "Bucketed: true" in plan[at] and "Join" in above[-1] and not any("Exchange" in line for line in above)
            assert "source" in plan[at][plan[at].index("PartitionFilters") :].split("]")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
