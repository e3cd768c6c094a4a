import threading

from pyspark.sql import functions as F

from pairloom.operators.claims import Claims


def jobs(spark, n=400):
    return spark.range(n).select(F.col("id"), F.concat(F.lit("url"), "id").alias("url"))


def test_two_writers_race_and_one_dies(spark, tmp_path):
    path = str(tmp_path / "claims")
    Claims.create(spark, path, jobs(spark), "id", 12)
    clock = [0.0]
    won: dict[str, list] = {"a": [], "b": [], "late": []}
    stopped = threading.Event()

    def writer(owner, session, dies_after):
        c = Claims(session, path)
        idle = 0
        while idle < 200:
            got = c.claim(owner, clock[0], 100.0)
            if not got:
                idle += 1
                if owner == "b":  # the other writer's time passes
                    stopped.wait(20)
                    clock[0] = 1000.0
                if len(c.state()[1]) == 12:
                    return
                continue
            if len(won[owner]) == dies_after:  # it holds a lot, and is gone
                won["late"] += got
                stopped.set()
                return
            won[owner] += got
            done = c.rows(got).withColumn("by", F.lit(owner)).drop("lot")
            assert c.complete(got[0], done)
        raise AssertionError("never done")

    errors = []

    def run(*args):
        try:
            writer(*args)
        except BaseException as e:
            errors.append(e)
            stopped.set()

    threads = [threading.Thread(target=run, args=x) for x in (("a", spark.newSession(), 2), ("b", spark.newSession(), None))]
    for t in threads:
        t.start()
    for t in threads:
        t.join(240)
    assert not errors, errors
    lots = [c.lot for c in won["a"] + won["b"]]
    assert sorted(lots) == list(range(12)) and len(won["a"]) == 2 and len(won["late"]) == 1
    # The dead one wakes: its results don't count.
    late = won["late"][0]
    c = Claims(spark, path)
    assert not c.complete(late, c.rows([late]).withColumn("by", F.lit("late")).drop("lot"))
    got = c.results().collect()
    assert sorted(r["id"] for r in got) == list(range(400)) and {r["by"] for r in got} == {"a", "b"}


def test_only_one_of_many_gets_a_lot(spark, tmp_path):
    path = str(tmp_path / "claims")
    Claims.create(spark, path, jobs(spark, 50), "id", 3)
    got = []
    barrier = threading.Barrier(8)

    def one(i):
        c = Claims(spark, path)
        barrier.wait()
        got.extend(c.claim(f"w{i}", 0.0, 10.0, 3))

    threads = [threading.Thread(target=one, args=(i,)) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(c.lot for c in got) == [0, 1, 2] and {c.epoch for c in got} == {1}
    c = Claims(spark, path)
    assert c.claim("x", 9.0, 10.0, 3) == [] and c.results() is None
    again = c.claim("x", 10.0, 10.0, 3)
    assert [(a.lot, a.epoch) for a in again] == [(0, 2), (1, 2), (2, 2)]
    assert c.rows(again[:1]).count() + c.rows(again[1:]).count() == 50
    plan = c.rows(again[:1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(lot" in plan
