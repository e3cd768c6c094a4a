import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pairloom.llm import common as C


@pytest.mark.parametrize(("rows", "size", "want"), [(2, 100, [2, 2, 1]), (10, 6, [2, 1, 2]), (10, 1, [1, 1, 1, 2]), (10, 100, [5])])
def test_slices(rows, size, want):
    b = pa.RecordBatch.from_pydict({"n": pa.array([1, 2, 3, 4, 5]), "t": pa.array(["abc", "de", "fghijklmnop", None, "q"])})
    got = list(C.slices([b, b.slice(0, 0)], rows, size))
    assert [x.num_rows for x in got] == want
    assert [t for x in got for t in x.column(1).to_pylist()] == b.column(1).to_pylist()


def test_written_tables(spark):
    df = spark.range(5).select("id", F.lit(None).alias("nothing"), F.lit("x").alias("s"))
    for plain in (False, True):
        got = C.written(df, "t", plain)
        assert got.columns == df.columns and got.count() == 5 and got.schema["nothing"].dataType.simpleString() == "string"
    assert C.small(got, 5) and not C.small(got, 4)
    C.cleanup(spark)
    with pytest.raises(Exception):
        got.collect()


def test_word_count(spark):
    df = spark.createDataFrame([("a b\x0bc\x1cd e",), (None,), (" \n",)], "t string")
    assert [r[0] for r in df.select(C.word_count("t")).collect()] == [4, 0, 0]
