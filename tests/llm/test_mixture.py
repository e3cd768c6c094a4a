import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom.llm import mixture as M


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def plain_targets(sizes, weights, total, repeats):
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        rest = total - sum(out[i] for i in range(len(sizes)) if i not in free)
        share = sum(w[i] for i in sorted(free))
        over = {i for i in free if rest * w[i] / share > repeats * sizes[i]}
        for i in over:
            out[i] = float(repeats * sizes[i])
        if not over:
            for i in free:
                out[i] = rest * w[i] / share
            break
        free -= over
    return out


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 100, 100], [0, 5, 0], [7], [], [1, 1, 1000], [3, 1, 4, 1, 5, 9, 2, 6], [0, 0], [1, 2, 4, 8, 16, 32, 64, 128, 4096]])
def test_targets(spark, sizes):
    total = float(sum(sizes))
    names = [f"s{i:02d}" for i in range(len(sizes) - 1)] + [None]  # null is last
    df = spark.createDataFrame([(n, x, x) for n, x in zip(names, sizes, strict=False)], "source string, source_size long, own long").repartition(3)
    by = {r.source: r.target for r in M.with_targets(df, M.WEIGHTS, 3).collect()}
    got = [by[n] for n in names[: len(sizes)]]
    assert got == pytest.approx(plain_targets(sizes, M.WEIGHTS, total, 3))
    assert sum(got) == pytest.approx(total)
    w = [M.WEIGHTS[i % 3] for i in range(len(sizes))]
    free = [i for i in range(len(sizes)) if got[i] < 3 * sizes[i] - 1e-9]
    assert all(g <= 3 * s + 1e-9 for g, s in zip(got, sizes, strict=True))
    assert len({round(got[i] / w[i], 6) for i in free}) <= 1
    if free:  # a capped source would get no less by weight
        assert all(got[i] <= w[i] * got[free[0]] / w[free[0]] + 1e-9 for i in range(len(sizes)))


def cost(n, size, repeats):
    out = 0
    for r in range(repeats):
        part = min(size, max(0, n - r * size))
        out += r * part
    return out


def test_flow_is_maximal_and_of_least_cost():
    """Against all splits, on small networks."""
    rnd = random.Random(1)
    shapes = [("a",), ("b",), ("a", "b"), ("a", "b", "c")]
    for _ in range(40):
        patterns = {p: rnd.randrange(1, 4) for p in rnd.sample(shapes, 3)}
        quotas = {s: rnd.randrange(0, 5) for s in "abc"}
        flow = M.route(patterns, quotas, 2)
        taken = {p: sum(f.values()) for p, f in flow.items()}
        assert all(set(f) <= set(p) for p, f in flow.items()) and all(n <= 2 * patterns[p] for p, n in taken.items())
        assert all(sum(f.get(s, 0) for f in flow.values()) <= quotas[s] for s in "abc")
        choices = [list(itertools.product(*(range(quotas[s] + 1) for s in p))) for p in patterns]
        best = None
        for split in itertools.product(*choices):
            by = {s: 0 for s in "abc"}
            total, dear = 0, 0
            for p, x in zip(patterns, split, strict=True):
                if sum(x) > 2 * patterns[p]:
                    break
                for s, n in zip(p, x, strict=True):
                    by[s] += n
                total += sum(x)
                dear += cost(sum(x), patterns[p], 2)
            else:
                if all(by[s] <= quotas[s] for s in "abc"):
                    best = min(best or (0, 0), (-total, dear))
        assert best == (-sum(taken.values()), sum(cost(n, patterns[p], 2) for p, n in taken.items()))


def test_query(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in M.query(spark, sf).collect()}
    assert got.keys() == docs.keys()
    names = sorted({r.source for r in docs.values()})
    sizes = [sum(words(r.text) for r in docs.values() if r.source == s) for s in names]
    goal = dict(zip(names, plain_targets(sizes, (5, 2, 1), float(sum(sizes)), 3), strict=True))
    for d, r in got.items():
        assert r.size == words(docs[d].text) and r.target == pytest.approx(goal[docs[d].source])
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[names.index(docs[d].source)]
    for s in names:
        taken = sum(r.taken for d, r in got.items() if docs[d].source == s)
        longest = max(r.size for d, r in got.items() if docs[d].source == s)
        assert abs(taken - goal[s]) <= longest / 2, s  # ten short and long documents a source here
    again = {r.doc_id: r.taken for r in M.query(spark, sf).collect()}
    assert again == {d: r.taken for d, r in got.items()}


def plain_copies(rows, x, repeats=3):
    """rows: (key, size) of one source; copies of each by laying them out in order."""
    rows = sorted(rows)
    total = sum(s for _, s in rows)
    layer, place = divmod(x, total)
    at, out = 0, {}
    for k, s in rows:
        out[k] = layer + (at + s / 2 < place)
        at += s
    short = x - sum(out[k] * s for k, s in rows)
    fits = [(abs(abs(short) - s), k) for k, s in rows if s and abs(abs(short) - s) < abs(short) and (out[k] < repeats if short > 0 else out[k] > 0)]
    if fits:
        out[min(fits)[1]] += 1 if short > 0 else -1
    return out


def test_selection_against_plain_layout(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(["w"] * rnd.choice((1, 5, 30, 400))), rnd.choice("aab")) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    slim = M.sized(df, F.array("source")).collect()
    got, p = M.mix(df)
    goal = {r.source: r.target for r in p.sources.collect()}
    mine = {r.doc_id: r.copies for r in got.collect()}
    for s in "ab":
        part = [r for r in slim if r.pattern == [s]]
        want = plain_copies([(r.key, r.size) for r in part], round(goal[s]))
        assert {r.doc_id: mine[r.doc_id] for r in part} == {r.doc_id: want[r.key] for r in part}
        assert abs(sum(mine[r.doc_id] * r.size for r in part) - goal[s]) <= 200  # of sizes up to 400


def test_overlapping_sources(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 60)), rnd.choice((["a"], ["a", "b"], ["b", "c"], ["c", None]))) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got, p = M.mix(df, F.col("source"))
    goal = {r.source: r.target for r in p.sources.collect()}
    taken = dict.fromkeys(goal, 0)
    for r in got.collect():
        assert len(r.copy_sources) == r.copies <= 3 and set(r.copy_sources) <= set(r.pattern)
        for s in r.copy_sources:
            taken[s] += r.size
    assert sum(goal.values()) == pytest.approx(sum(len(t.split()) for _, t, _ in rows))
    assert all(abs(taken[s] - goal[s]) < 150 for s in goal), (taken, goal)


def test_stage_and_odd_rows(spark):
    rows = [(1, "a b c", "s", 1), (1, "a b c", "s", 2), (None, None, None, 3), (2, "", None, 4), (3, "x " * 50, "t", 5), (4, "y y", None, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    out = M.mix_stage(df)
    assert out.columns == df.columns
    got, _ = M.mix(df)
    by_id = {(r.doc_id, r.size): r.copies for r in got.collect()}
    counted = {}
    for r in out.collect():
        counted[r.doc_id, words(r.text)] = counted.get((r.doc_id, words(r.text)), 0) + 1
    doubled = {k: v * (2 if k == (1, 3) else 1) for k, v in by_id.items() if v}
    assert counted == doubled
    assert M.mix_stage(df.limit(0)).count() == 0 and M.mix(df.limit(0))[0].count() == 0
    assert M.mix(df.where("doc_id = 2"))[0].first().copies == 0


def test_components_are_routed_apart(spark):
    """Two groups of overlapping sources and many lone ones: each group's flow is that of the
    group alone, and lone sources take their targets."""
    rnd = random.Random(12)
    groups = [["a"], ["a", "b"], ["b", "c"], ["x", "y"], ["y"], *[[f"lone{i}"] for i in range(30)]]
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 30)), rnd.choice(groups)) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source array<string>")
    got, p = M.mix(df, F.col("source"))
    goal = {r.source: r.target for r in p.sources.collect()}
    taken, tokens = dict.fromkeys(goal, 0), {}
    for r in got.collect():
        tokens[tuple(r.pattern)] = tokens.get(tuple(r.pattern), 0) + r.size
        for s in r.copy_sources:
            taken[s] += r.size
    assert all(abs(taken[s] - goal[s]) <= 90 for s in goal), (taken, goal)
    # the cuts are the ends of the flow that the whole network has
    flow = M.route(tokens, {s: round(t) for s, t in goal.items()}, 3)
    ends = {(tuple(r.pattern), r.source): r["at"] for r in M.flows(spark.createDataFrame([(list(k), n) for k, n in tokens.items()], "pattern array<string>, tokens long"), p.sources, 3).collect()}
    for k, out in flow.items():
        at = 0
        for s in sorted(out):
            at += out[s]
            assert ends.pop((k, s)) == at
    assert not ends


def test_more_sources_than_before(spark):
    """25,000 sources, each with a pattern of its own."""
    df = spark.range(25_000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.concat(F.lit("h"), F.col("id").cast("string")).alias("source"))
    got, p = M.mix(df)
    assert got.count() == 25_000 == p.sources.count()
    assert got.agg(F.sum(F.col("copies") * F.col("size"))).first()[0] > 0 and got.agg(F.max("copies")).first()[0] <= 3


def test_equal_rows_are_mended_together(spark):
    """A hundred rows of one doc_id and text: none is added where all would be too many."""
    rows = [(1, "w " * 7, "a")] * 100 + [(i, "w " * 400, "b") for i in range(2, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, p = M.mix(df)
    goal = {r.source: r.target for r in p.sources.collect()}
    taken = {s: 0 for s in goal}
    for r in got.collect():
        taken[r.pattern[0]] += r.copies * r.size
    assert abs(taken["a"] - goal["a"]) <= 350 and abs(taken["b"] - goal["b"]) <= 200


def test_overlapping_query_and_a_very_long_text(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in M.overlap_query(spark, sf).collect()}
    assert got.keys() == docs.keys()
    assert all(set(r.pattern) == {docs[d].source, f"language {docs[d].lang}"} and set(r.copy_sources) <= set(r.pattern) and len(r.copy_sources) == r.copies for d, r in got.items())
    assert {s.startswith("language ") for r in got.values() for s in r.copy_sources} == {True, False}
    long = spark.createDataFrame([(1, "w " * 1_000_000, "a"), (2, "w", "b")], "doc_id long, text string, source string")
    assert {r.doc_id: r.size for r in M.mix(long)[0].collect()} == {1: 1_000_000, 2: 1}
