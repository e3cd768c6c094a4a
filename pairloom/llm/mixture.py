"""Mixing sources to target weights by a min-cost flow.

Documents may belong to several sources.  They are aggregated by membership pattern; the
flow network runs from the patterns' tokens (one arc for each repetition of a pattern's
documents, each dearer than the one before) over the patterns' sources to the sources'
quotas.  So tokens are repeated only where quotas can't be met without.  Each pattern's
flow becomes a line: its documents in seeded order, laid out once for each repetition;
the sources take stretches of the line in turn, and the taken end is a cut (repetition,
place in the order).  A document's copies then follow from its own key and its pattern's
cuts, in one expression.

The place of a cut is found without a global sort: token sums of 4096 ranges of the
seeded key, then a running sum within the ranges that hold a cut.  Last, one document of
each pattern, the one whose size is nearest to what the cut left over or short, gets a
copy more or less.

Sources, patterns and cuts are tables; the driver sees sums only.  Targets are found by
rounds over the table of sources, each of which stops those that are above.  A source
that no overlapping pattern has gets its target from its one pattern, in a column.  The
others' patterns are cut into the connected components of patterns and sources, whose
flows don't touch each other, and each component is routed by one worker, which holds
a row a pattern.

Edge cases: null is a source of its own, last in order; null and empty texts have size 0
and no copies unless all else of their source is taken whole; rows equal in doc_id and
text get equal copies, which the mend counts; no rows give no rows; other columns are ignored by ``mix`` and
kept by the stage.
"""

from __future__ import annotations

from collections import defaultdict, deque

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ranges
from .common import documents, maybe_broadcast, word_count, written
from .simhash import components

WEIGHTS = (5.0, 2.0, 1.0)
REPEATS = 3
SEED = 20_240_501
#: Bits of the seeded key by which token sums are kept.
RANGE_BITS = 12


def with_targets(sources: DataFrame, weights: tuple[float, ...], repeats: int) -> DataFrame:
    """``sources`` (source, source_size, own) with ``target``, a written table: the sum of ``own``
    shared by weight (repeating, in code point order, null last); a target stops at
    ``repeats`` times its source's size and the excess is shared again, until none is above."""
    ordered = ranges.numbered(sources.withColumn("last", F.col("source").isNull()), [], ["last", "source"], "i")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("i") - 1, F.lit(len(weights))) + 1).cast("int"))
    df = written(ordered.select("source", "source_size", "own", weight.alias("weight"), (F.col("source_size") * repeats).alias("most")), "sources")
    total, capped = df.agg(F.sum("own")).first()[0] or 0, F.lit(False)
    before, share = None, None
    while True:
        free = df.agg(F.sum(F.when(~capped, F.col("weight"))), F.sum(F.when(capped, F.col("most"))), F.count_if(capped)).first()
        # Those over the share stop; a share only grows, so none is let go again.
        if not free[0] or free[2] == before:
            break
        before, share = free[2], (float(total) - (free[1] or 0)) / free[0]
        capped = F.col("weight") * F.lit(share) > F.col("most")
    target = F.col("most").cast("double") if share is None or not free[0] else F.when(capped, F.col("most").cast("double")).otherwise(F.col("weight") * F.lit(share))
    return written(df.select("source", "source_size", target.alias("target")), "targets")


def route(patterns: dict[tuple, int], quotas: dict, repeats: int) -> dict[tuple, dict]:
    """Tokens that each pattern sends to each of its sources: a maximum flow of least cost.

    The r-th repetition of a pattern's tokens costs r - 1 each.  Augmenting paths are
    taken in order of cost: a path leaves the start once, so all paths of the first
    repetition come before those of the second.
    """
    flow: dict[tuple, dict] = {p: defaultdict(int) for p in patterns}
    members = defaultdict(list)
    for p in patterns:
        for s in p:
            members[s].append(p)
    left = dict(quotas)
    for _ in range(repeats):
        supply = dict(patterns)
        for p in sorted(patterns, key=repr):
            while supply[p] > 0:
                # Shortest path from p to a source with quota left; a source's flow from
                # another pattern can be sent elsewhere.
                came: dict = {("p", p): None}
                queue, end = deque([("p", p)]), None
                while queue and end is None:
                    kind, x = node = queue.popleft()
                    if kind == "p":
                        for s in x:
                            if ("s", s) not in came:
                                came["s", s] = node
                                if left.get(s, 0) > 0:
                                    end = ("s", s)
                                    break
                                queue.append(("s", s))
                    else:
                        for q in members[x]:
                            if flow[q][x] > 0 and ("p", q) not in came:
                                came["p", q] = node
                                queue.append(("p", q))
                if end is None:
                    break
                path = [end]
                while came[path[-1]] is not None:
                    path.append(came[path[-1]])
                path.reverse()
                amount = min(supply[p], left[end[1]], *(flow[path[i + 1][1]][path[i][1]] for i in range(1, len(path) - 1, 2)))
                for i in range(len(path) - 1):
                    a, b = path[i], path[i + 1]
                    if a[0] == "p":
                        flow[a[1]][b[1]] += amount
                    else:
                        flow[b[1]][a[1]] -= amount
                supply[p] -= amount
                left[end[1]] -= amount
    return {p: {s: n for s, n in f.items() if n > 0} for p, f in flow.items()}


def _key(doc_id: str, text: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))


def _range(key: Column) -> Column:
    return F.shiftright(key, 64 - RANGE_BITS)


class Plan:
    """What a mix decides: per source its size and target, per pattern its cuts."""

    def __init__(self, sources: DataFrame, cuts: DataFrame):
        #: source, source_size, target
        self.sources = sources
        #: pattern, cuts (array of repetition, key and source, in order), mend_key, mend
        self.cuts = cuts


_CUTS = "pattern array<string>, source string, at long, layer long, place long"


def flows(patterns: DataFrame, sources: DataFrame, repeats: int) -> DataFrame:
    """(pattern, source, at, layer, place): the ends of the sources' stretches on the lines of
    ``patterns`` (pattern, tokens); ``sources`` has source and target."""
    names = {c: f"of_{c}" for c in sources.columns}
    quota = sources.withColumnsRenamed(names).withColumn("quota", F.bround("of_target").cast("long"))
    parts = written(patterns.withColumn("source", F.explode("pattern")).join(maybe_broadcast(quota.select("of_source", "quota")), F.col("source").eqNullSafe(F.col("of_source"))).select("pattern", "tokens", "source", "quota"), "parts")
    overlapping = parts.where(F.size("pattern") > 1)
    lone = parts.where("quota > 0 and tokens > 0")
    if overlapping.isEmpty():
        routed = parts.sparkSession.createDataFrame([], _CUTS)
    else:
        shared = written(overlapping.select(F.col("source").alias("shared")).distinct(), "shared")
        held = written(parts.join(maybe_broadcast(shared), F.col("source").eqNullSafe(F.col("shared")), "left_semi"), "overlapping")
        lone = lone.join(maybe_broadcast(shared), F.col("source").eqNullSafe(F.col("shared")), "left_anti")
        pattern, source = F.xxhash64(F.lit(1), F.to_json(F.struct("pattern"))), F.xxhash64(F.lit(2), "source")
        edges = held.select(pattern.alias("p"), source.alias("s"))
        to = components(edges.select(F.col("p").alias("a"), F.col("s").alias("b"))).withColumnsRenamed({"a": "node", "b": "root"})
        placed = held.withColumn("p", pattern).join(to, F.col("p") == F.col("node"), "left").withColumn("component", F.coalesce("root", "p"))

        def run(f: pd.DataFrame) -> pd.DataFrame:
            tokens = {tuple(p): int(t) for p, t in zip(f["pattern"], f["tokens"], strict=True)}
            quotas = {s if isinstance(s, str) else None: int(q) for s, q in zip(f["source"], f["quota"], strict=True)}
            ends = []
            for p, out in route(tokens, quotas, repeats).items():
                at = 0
                for s in sorted(out, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass"))):
                    at += out[s]
                    ends.append((list(p), s, at, *divmod(at, tokens[p])))
            return pd.DataFrame(ends, columns=["pattern", "source", "at", "layer", "place"])

        routed = placed.select("component", "pattern", "tokens", "source", "quota").groupBy("component").applyInPandas(run, _CUTS)
    alone = lone.withColumn("at", F.least("quota", F.col("tokens") * repeats)).select("pattern", "source", "at", F.expr("at div tokens").alias("layer"), F.expr("at % tokens").alias("place"))
    return written(alone.unionByName(routed), "ends")


def plan(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> Plan:
    """The plan for ``sized``: pattern (array of sources), size and key of each document."""
    ranges_ = written(sized.groupBy("pattern", _range(F.col("key")).alias("range")).agg(F.sum("size").alias("tokens")), "ranges")
    patterns = written(ranges_.groupBy("pattern").agg(F.sum("tokens").alias("tokens")), "patterns")
    # ``own``: each pattern's tokens count once, for the least of its sources.
    own = F.when(F.col("place") == 0, F.col("tokens")).otherwise(F.lit(0))
    by_source = patterns.select("tokens", F.posexplode("pattern").alias("place", "source")).groupBy("source").agg(F.sum("tokens").alias("source_size"), F.sum(own).alias("own"))
    sources = with_targets(by_source, weights, repeats)
    cuts = flows(patterns, sources, repeats)

    # The range that holds each cut, then the first document whose middle is past it.
    before = ranges_.select("pattern", "range", "tokens", F.expr("sum(tokens) over (partition by pattern order by range) - tokens").alias("before"))
    at_range = maybe_broadcast(cuts).join(before, "pattern").where("place >= before and place < before + tokens")
    held = written(at_range.select("pattern", "source", "at", "layer", "range", (F.col("place") - F.col("before")).alias("rest")), "held")
    near = sized.select("pattern", "size", "key", _range(F.col("key")).alias("range")).join(maybe_broadcast(held.select("pattern", "range").distinct()), ["pattern", "range"])
    running = near.select("pattern", "range", "key", (F.expr("sum(size) over (partition by pattern, range order by key, size rows unbounded preceding)") - F.col("size") / 2).alias("middle"))
    first = running.join(held, ["pattern", "range"]).where("middle >= rest").groupBy("pattern", "source", "at").agg(F.min("key").alias("first"))
    found = held.join(first.withColumnsRenamed({"pattern": "p", "source": "s", "at": "a"}), (F.col("pattern") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("at") == F.col("a")), "left")
    # Without such a document the cut is the range's end.
    end = F.shiftleft((F.col("range") + 1).cast("long"), 64 - RANGE_BITS) if RANGE_BITS else F.lit(None)
    key = F.coalesce("first", F.when(F.col("range") < (1 << (RANGE_BITS - 1)) - 1, end).otherwise(F.lit((1 << 63) - 1)))
    lists = found.groupBy("pattern").agg(F.array_sort(F.collect_list(F.struct("at", "layer", key.alias("key"), "source"))).alias("cuts"))
    lists = written(lists, "cuts")

    # One document of each pattern mends what is over or short.
    joined = sized.join(maybe_broadcast(lists), "pattern").withColumn("copies", _copies(F.col("key")))
    joined = joined.join(maybe_broadcast(lists.select("pattern", F.expr("element_at(cuts, -1).at").alias("wanted"))), "pattern")
    taken = written(joined.groupBy("pattern", "wanted").agg(F.sum(F.col("copies") * F.col("size")).alias("taken")), "taken")
    short = taken.select("pattern", (F.col("wanted") - F.col("taken")).alias("short"))
    fit = F.abs(F.abs("short") - F.col("size"))
    can = (F.col("size") > 0) & (fit < F.abs("short")) & F.when(F.col("short") > 0, F.col("copies") < repeats).otherwise(F.col("copies") > 0)
    mends = joined.drop("wanted").join(maybe_broadcast(short), "pattern").where(can).groupBy("pattern").agg(F.min(F.struct(fit.alias("fit"), "key", F.signum("short").cast("int").alias("sign"))).alias("m"))
    mends = written(mends.select(F.col("pattern").alias("p"), F.col("m.key").alias("mend_key"), F.col("m.sign").alias("mend")), "mends")
    # Rows equal in doc_id and text are mended together: only where that is nearer, too.
    many = sized.join(maybe_broadcast(mends), (F.col("pattern") == F.col("p")) & (F.col("key") == F.col("mend_key"))).groupBy("p").agg(F.sum("size").alias("mended"))
    near = short.join(maybe_broadcast(many), F.col("pattern") == F.col("p")).where("mended < 2 * abs(short)").select(F.col("p").alias("fine"))
    mends = written(mends.join(maybe_broadcast(near), F.col("p") == F.col("fine"), "left_semi"), "fine-mends")
    return Plan(sources, written(lists.join(maybe_broadcast(mends), F.col("pattern") == F.col("p"), "left").select("pattern", "cuts", "mend_key", "mend"), "plan"))


def _copies(key: Column) -> Column:
    """Copies of a document by the last of its pattern's cuts."""
    last = F.element_at("cuts", -1)
    return last["layer"] + F.when(key < last["key"], 1).otherwise(0)


def mended_copies(key: Column) -> Column:
    """Copies by the cuts and the mend; none where the pattern has no cuts."""
    return F.coalesce(_copies(key), F.lit(0)) + F.when(key == F.col("mend_key"), F.col("mend")).otherwise(0)


def sources_of_copies(key: Column) -> Column:
    """The source that each copy of a document counts for, in order of the copies."""
    source = lambda l: F.try_element_at(F.filter("cuts", lambda c: (c["layer"] > l) | ((c["layer"] == l) & (key < c["key"]))), F.lit(1))["source"]  # noqa: E731, E741
    none = F.array().cast("array<string>")
    n = mended_copies(key)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda l: F.coalesce(source(l), F.element_at("cuts", -1)["source"]))).otherwise(none)  # noqa: E741


def sized(docs: DataFrame, pattern: Column, seed: int = SEED) -> DataFrame:
    return docs.select("doc_id", F.array_sort(F.array_distinct(pattern)).alias("pattern"), word_count("text").alias("size"), _key("doc_id", "text", seed).alias("key"))


def mix(docs: DataFrame, pattern: Column | None = None, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED) -> tuple[DataFrame, Plan]:
    """(doc_id, pattern, size, copies, copy_sources) of each document, and the plan.

    ``pattern``: an array of the document's sources; by default its one source.
    """
    slim = written(sized(docs, F.array("source") if pattern is None else pattern, seed), "sized", plain=True)
    p = plan(slim, weights, repeats)
    joined = slim.join(maybe_broadcast(p.cuts), "pattern", "left")
    return joined.select("doc_id", "pattern", "size", mended_copies(F.col("key")).alias("copies"), sources_of_copies(F.col("key")).alias("copy_sources")), p


def mix_stage(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; all columns stay as they are."""
    names = {c.lower(): c for c in docs.columns}
    plain = docs.select(F.col(names["doc_id"]).alias("doc_id"), F.col(names["text"]).alias("text"), F.col(names["source"]).alias("source"))
    p = plan(written(sized(plain, F.array("source"), seed), "sized", plain=True), weights, repeats)
    cuts = maybe_broadcast(p.cuts.withColumnRenamed("pattern", "__pl_pattern"))
    keyed = docs.withColumns({"__pl_key": _key(names["doc_id"], names["text"], seed), "__pl_of": F.array(F.col(names["source"]))})
    joined = keyed.join(cuts, F.col("__pl_of") == F.col("__pl_pattern"))
    copies = joined.withColumn("__pl_n", mended_copies(F.col("__pl_key"))).where("__pl_n > 0")
    return copies.withColumn("__pl_copy", F.explode(F.sequence(F.lit(1), F.col("__pl_n").cast("int")))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, p = mix(documents(spark, sf_dir))
    source = F.element_at("pattern", 1)
    joined = got.withColumn("of", source).join(maybe_broadcast(p.sources), F.col("of").eqNullSafe(F.col("source")))
    return joined.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", F.col("copies").cast("int").alias("copies"))


def overlap_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by sources that overlap: a document's own, and its language."""
    docs = documents(spark, sf_dir)
    got, p = mix(docs, F.array("source", F.concat(F.lit("language "), F.coalesce("lang", F.lit("?")))))
    return got.select("doc_id", "pattern", "size", F.col("copies").cast("int").alias("copies"), "copy_sources")
