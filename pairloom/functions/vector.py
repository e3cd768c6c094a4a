"""Vectors (M2-M5, P10): cosine and zero-shot ranking in array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col, mentions_minor

EPSILON = 1e-6
#: P10: least similarity by set; the legacy value for all sets was 0.30.
THRESHOLD = {"en": 0.28}
THRESHOLD_OTHER = 0.26
#: M4: first index of the adult categories, of the safe ages, and of the lifeless things' end.
ADULT, SAFE_AGE, LAST_SAFE_THING = 19, 4, 20
#: M5: sizes of the category lists; vectors and labels come from the caller's encoder.
CATEGORIES = {"main": 35, "ages": 8, "animals": 33}


def dot(a: str | Column, b: str | Column) -> Column:
    d = lambda c: F.transform(c, lambda x: x.cast("double"))
    return F.aggregate(F.zip_with(d(a), d(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: str | Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: str | Column, b: str | Column) -> Column:
    """M2, in double; the norms' product is at least EPSILON."""
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(EPSILON))


def similar_enough(similarity: str | Column, route: str | Column) -> Column:
    """P10: equality is kept."""
    least = F.when(col(route) == "en", THRESHOLD["en"]).otherwise(THRESHOLD_OTHER)
    return F.coalesce(col(similarity) >= least, F.lit(False))


def category_labels(name: str) -> list[str]:
    """M5: neutral placeholders, one a category."""
    return [f"{name} {i}" for i in range(CATEGORIES[name])]


def top_categories(df: DataFrame, vector: str, categories: DataFrame, k: int = 2, out: str = "top") -> DataFrame:
    """``df`` with an array of (idx, score) of the ``k`` best categories, ties to
    the smaller index.

    ``categories`` (idx, vec) is a fixed list of some dozens (``CATEGORIES``): it is packed
    in one value, a scalar subquery, so no join is made and each row of ``df`` stays one
    row.  Softmax keeps the order of cosines, so none is taken here; see ``softmax``.
    """
    packed = categories.agg(F.array_sort(F.collect_list(F.struct("idx", "vec"))).alias("__categories")).scalar()
    scores = F.transform("__categories", lambda c: F.struct((-F.round(cosine(F.col(vector), c["vec"]), 9)).alias("n"), c["idx"].alias("idx")))
    best = F.transform(F.slice(F.array_sort(scores), 1, k), lambda s: F.struct(s["idx"].alias("idx"), (-s["n"]).alias("score")))
    return df.withColumn("__categories", packed).withColumn(out, best).drop("__categories")


def softmax(scores: str | Column, scale: float = 100.0) -> Column:
    """Of an array of cosines, times ``scale``."""
    top = F.array_max(scores)
    e = F.transform(scores, lambda x: F.exp(scale * (x - top)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def safety(similarity: str | Column, least: str | Column, main: str | Column, ages: str | Column, animals: str | Column, text: str | Column, adult: int = ADULT) -> Column:
    """M4: struct of tag and dropped, from arrays of the best category indices."""
    a, b = F.get(main, F.lit(0)), F.get(main, F.lit(1))
    both = (a >= adult) & (b >= adult)
    young = (F.get(ages, F.lit(0)) < SAFE_AGE) | (F.get(ages, F.lit(1)) < SAFE_AGE)
    low = ~F.coalesce(col(similarity) >= col(least), F.lit(False))
    tag = F.when(low, F.lit(None)).when((a < adult) & (b < adult), "UNLIKELY").when(both, "NSFW").otherwise("UNSURE")
    drop = low | (both & (young | mentions_minor(text) | (F.get(animals, F.lit(0)) > LAST_SAFE_THING)))
    return F.struct(tag.alias("nsfw"), F.coalesce(drop, F.lit(False)).alias("dropped"))


def encoded(df: DataFrame, columns: list[str], schema: str, encoder, batch: int = 256) -> DataFrame:
    """M1: ``df`` through an injected encoder: a factory, called once a worker task, of a
    function from a pandas frame of at most ``batch`` rows to one with ``schema``."""

    def run(frames):
        encode = encoder()
        for f in frames:
            for i in range(0, len(f), batch):
                yield encode(f.iloc[i : i + batch])

    return df.select(*columns).mapInPandas(run, schema)
