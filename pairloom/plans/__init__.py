"""The three stages end to end (the surveyed entries): parse, download, score.

Each is one lazy plan; the caller writes the frames it returns.  Order of commits: rows
first, then the seen set, so a crash between them costs a repeated test, never rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import image as I  # noqa: E741
from ..functions import text as X
from ..functions import vector as V
from ..operators import dedup as D
from ..operators import links as L
from ..operators import state as S


def parse(lines: DataFrame, seen: DataFrame, start: str | Column, mode: str = "strict", detector=None, fix=None) -> dict[str, DataFrame]:
    """Stage 1: crawl lines (wat, line, value) and the seen addresses (url) to the frames
    ``rows`` (candidates with ids and route) and ``keys`` (addresses to add to the seen set)."""
    licensed = L.with_license(L.crawl_links(lines), ["wat", "line"])
    found = L.candidates(licensed, mode, detector, fix)
    fresh = D.unseen(D.first_by(found, ["wat", "url"], ["line", "pos"]), seen, "url")
    rows = D.with_ids(fresh, ["wat"], ["line", "pos"], start).withColumn("route", S.route("language"))
    return {"rows": rows.select("sampleid", "url", "text", "license", "domain", "wat", "hash", "language", "route"), "keys": fresh.select(F.trim("url").alias("url")).distinct()}


def download(table: DataFrame, n: int, fetch, key: str = "sampleid", now: Column | None = None) -> dict[str, DataFrame]:
    """Stage 2: claim, fetch, check, write back.  ``fetch`` maps the claimed rows to results
    (sampleid, status, width, height)."""
    claimed = S.claim(table, key, n)
    results = fetch(claimed)
    after = S.sweep(S.complete(S.apply_claim(table, claimed, key, now), results, key, ["status", "width", "height"], now), claimed, results, key)
    return {"table": after, "results": results.where(F.col("status") == S.OK)}


def checked(df: DataFrame) -> DataFrame:
    """P8 on fetched rows."""
    return df.withColumn("status", I.status("n_bytes", "width", "height", "format", "failed"))


def score(pairs: DataFrame, seen: DataFrame, categories: dict[str, DataFrame], image: str = "image_vec", text: str = "text_vec", route: str = "route") -> dict[str, DataFrame]:
    """Stage 3: pairs of shards (shard_seq, row_seq, url, text, route and vectors) to
    ``scored`` (all, with tag and drop) and ``kept``."""
    last = D.last_by(pairs, ["url", "text"], ["shard_seq", "row_seq"]).withColumn("hash", X.pair_hash("url", "text", compat=True))
    df = D.unseen(last, seen, "hash").withColumn("similarity", V.cosine(image, text))
    for name in ("main", "ages", "animals"):
        df = V.top_categories(df, image, categories[name], out=f"__{name}")
    least = F.when(F.col(route) == "en", V.THRESHOLD["en"]).otherwise(V.THRESHOLD_OTHER)
    index = lambda c: F.transform(c, lambda x: x["idx"])
    tag = V.safety("similarity", least, index(F.col("__main")), index(F.col("__ages")), index(F.col("__animals")), "text")
    scored = df.withColumn("__s", tag).withColumns({"nsfw": F.col("__s.nsfw"), "dropped": F.col("__s.dropped")}).drop("__s", "__main", "__ages", "__animals")
    return {"scored": scored, "kept": scored.where(~F.col("dropped"))}
