import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom import streaming as T
from pairloom.operators.seen import SeenSet


def table(spark, keys):
    return spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, k string")


@pytest.fixture
def seen(spark, tmp_path):
    s = SeenSet(spark, str(tmp_path / "set"), 5000, 8)
    yield s
    s.close()


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_against_python_sets(spark, seen):
    rng = random.Random(1)
    held: set[str] = set()
    for n in range(4):
        batch = [rng.choice([None, "", f"key {rng.randrange(900)}", f" key {rng.randrange(900)} ", f"é{rng.randrange(50)}"]) for _ in range(400)]
        df = table(spark, batch)
        trimmed = [None if k is None else k.strip(" ") for k in batch]
        assert ids(seen.unseen(df, "k")) == [i for i, k in enumerate(trimmed) if k is None or k not in held]
        assert ids(seen.already_seen(df, "k")) == [i for i, k in enumerate(trimmed) if k is not None and k in held]
        new = {r["key"] for r in seen.add(df, "k", f"b{n}").collect()}
        assert new == {k for k in trimmed if k is not None} - held
        held |= new
    assert {r["key"] for r in seen.keys().collect()} == held and seen.keys().count() == len(held)


def test_an_addition_is_repeated_under_its_name(spark, seen):
    seen.add(table(spark, ["a", "b"]), "k", "one")
    for _ in range(2):
        assert {r["key"] for r in seen.add(table(spark, ["b", "c", "d"]), "k", "two").collect()} == {"c", "d"}
    assert sorted(r["key"] for r in seen.keys().collect()) == ["a", "b", "c", "d"]
    seen.add(table(spark, ["c"]), "k", "two")  # what was there under the name is overwritten
    assert sorted(r["key"] for r in seen.keys().collect()) == ["a", "b", "c"]
    for name in ("", "a/b", "..", "a=b"):
        with pytest.raises(ValueError):
            seen.add(table(spark, ["x"]), "k", name)


def test_a_filter_without_its_keys_claims_and_is_settled(spark, seen):
    from pairloom.operators import seen as module

    keys = spark.createDataFrame([("lost",)], "key string")
    seen._write(seen._filter, module.filled(keys, seen.blocks), "block", "cut")
    assert [r["key"] for r in seen.claims(keys).collect()] == ["lost"]
    assert ids(seen.unseen(table(spark, ["lost"]), "k")) == [0]


def test_reopened_merged_and_compacted(spark, seen, tmp_path):
    a = [f"a{i}" for i in range(3000)]
    seen.add(table(spark, a[:2000]), "k", "x")
    again = SeenSet(spark, seen.path, 99, 3)
    assert (again.blocks, again.shards) == (seen.blocks, seen.shards)
    other = SeenSet(spark, str(tmp_path / "other"), 100, 4)  # far too small: it claims more, and misses nothing
    other.add(table(spark, a[1000:]), "k", "y")
    assert again.merge(other, "z").count() == 1000
    for expected in (None, 50_000):
        c = again.compact("all", str(tmp_path / f"compact{expected}"), expected)
        assert c.filter().groupBy("block").count().where("count > 1").count() == 0
        assert ids(c.unseen(table(spark, [*a, "new"]), "k")) == [3000]
        c.close()
    other.close()
    seen.vacuum()


def test_false_claims_are_few_and_little_is_read(spark, seen):
    seen.add(spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k")), "k", "all")
    others = spark.range(5000, 15000).select(F.concat(F.lit("k"), "id").alias("k"))
    got = {r["what"]: r["keys"] for r in seen.share_read(others, "k").collect()}
    assert got["asked"] == 10_000 and got["found"] == 0 and got["held"] == 5000
    assert got["claimed"] < 150
    got = {r["what"]: r["keys"] for r in seen.share_read(table(spark, ["k1", "none"]), "k").collect()}
    assert got["found"] == 1 and 0 < got["read"] < 2000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_neither_side_of_the_set_is_shuffled(spark, seen):
    seen.add(table(spark, [f"k{i}" for i in range(500)]), "k", "x")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = spark.createDataFrame([("k1",)], "key string")
        for df, table_name in ((seen.claims(keys), seen._filter), (seen.found(keys), seen._keys)):
            plan = plan_of(df)
            scan = next(i for i, line in enumerate(plan.splitlines()) if table_name in line)
            above = plan.splitlines()[:scan]
            depth = plan.splitlines()[scan].index("+-") if "+-" in plan.splitlines()[scan] else 0
            # An exchange that holds the scan would be an ancestor: less deep, and no other branch after it.
            path, limit = [], depth
            for line in reversed(above):
                at = len(line) - len(line.lstrip(" :+-"))
                if at < limit + 3 and at <= limit:
                    path.append(line)
                    limit = at - 1
            assert path and not any("Exchange" in line for line in path), plan
            assert "Bucketed: true" in plan
        assert re.search(r"PartitionFilters: \[.*shard", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


SCHEMA = "id long, k string"


def put(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_a_batch_that_fails_is_run_again_and_nothing_is_lost(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    put(spark, src, [(1, "a"), (2, "a"), (3, "b")])
    stream = lambda: T.file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, 1)
    T.dedup_once(stream(), "k", ["id"], out, cp).awaitTermination()
    put(spark, src, [(0, "a"), (4, "c"), (5, "d")])

    failed = []

    def failing(df, n):  # half the rows are written, then the batch dies
        df.where("k = 'c'").write.mode("overwrite").parquet(f"{out}/batch={n}")
        failed.append(n)
        raise RuntimeError("lost")

    with T._conf(spark, T.ROCKSDB), pytest.raises(Exception, match="lost"):
        q = T.first_of_key(stream(), "k", ["id"]).writeStream.outputMode("update").foreachBatch(failing)
        q.option("checkpointLocation", cp).trigger(availableNow=True).start().awaitTermination()
    assert failed
    T.dedup_once(stream(), "k", ["id"], out, cp).awaitTermination()
    got = sorted((r["id"], r["k"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, "a"), (3, "b"), (4, "c"), (5, "d")]


def test_a_batch_touches_its_own_keys_alone(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    for i in range(12):  # ten new keys a file, and one old
        put(spark, src, [(100 * i + j, f"{i}-{j}") for j in range(10)] + [(100 * i + 50, "0-0")])
    q = T.dedup_once(T.file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, 1), "k", ["id"], out, cp)
    q.awaitTermination()
    assert spark.read.parquet(out).count() == 120 and spark.read.parquet(out).where("k = '0-0'").first()["id"] == 0
    states = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert [s["numRowsUpdated"] for s in states if s["numRowsUpdated"]] == [10] + [11] * 11
    assert states[-1]["numRowsTotal"] == 120
    assert all(s["customMetrics"] and any("rocksdb" in k for k in s["customMetrics"]) for s in states)
