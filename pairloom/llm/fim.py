"""Fill-in-middle: a text is cut at two seeded places and its middle goes last.

Each Arrow batch is registered with a DuckDB inside ``mapInArrow``; one SQL query cuts the
texts into code points (``regexp_extract_all``), takes the parts (``list_slice``,
``array_to_string``), draws the cuts and the form from ``sha256`` and puts the output together.  A second query
rebuilds the texts from output and form alone.  Nothing runs in Python by the row, and results leave as Arrow.

The draw.  h1 to h4 are the first four 8-digit groups of the hex sha256 of ``seed:doc_id``.
The prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1) code points, the middle
after the larger.  A text is left plain if it is empty or holds a sentinel, or if
h3 % 100 >= ``rate``; else it is spm if h4 % 100 < ``spm``, else psm.

    psm  <P>prefix<S>suffix<M>middle
    spm  <S>suffix<P>prefix<M>middle

No sentinel ends with what it begins with, and texts that hold one are plain, so the
first place of each sentinel in an output is its own and the text comes back exactly.

Edge cases: a null text is an empty one (plain, n 0); a null doc_id is drawn as an empty
string; rows that share a doc_id are drawn alike, each for its own text, and repeated rows are repeated; no rows give no rows;
a text of any length is cut whole, in lots of at most ``LOT_BYTES`` of text (a longer text is a lot of its own); other
columns are ignored.
"""

from __future__ import annotations

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, slices, spread

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
#: Of a hundred texts, those that are transformed; of a hundred of these, those in the form spm.
RATE, SPM = 90, 20
#: Bytes of texts that a worker cuts at once: a code point takes some 16 bytes in a list.
LOT_BYTES = 2 << 20

_HASH = "('0x' || substr(h, {at}, 8))::BIGINT"

_CUT = """
CREATE TEMP TABLE cut AS
WITH points AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '(?s).') AS points, sha256({seed} || ':' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM batch
), drawn AS (
    SELECT doc_id, text, points, len(points) AS n, {h1} % (len(points) + 1) AS c1, {h2} % (len(points) + 1) AS c2, {h3} % 100 AS d1, {h4} % 100 AS d2
    FROM points
), formed AS (
    SELECT doc_id, text, points, n, least(c1, c2) AS a, greatest(c1, c2) AS b,
        CASE WHEN n = 0 OR contains(text, '{P}') OR contains(text, '{S}') OR contains(text, '{M}') OR d1 >= {rate} THEN 'plain' WHEN d2 < {spm} THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT doc_id, text, n, a, b, form,
        CASE WHEN form <> 'plain' THEN array_to_string(list_slice(points, 1, a), '') END AS prefix,
        CASE WHEN form <> 'plain' THEN array_to_string(list_slice(points, a + 1, b), '') END AS middle,
        CASE WHEN form <> 'plain' THEN array_to_string(list_slice(points, b + 1, n), '') END AS suffix
    FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{P}' || prefix || '{S}' || suffix || '{M}' || middle ELSE '{S}' || suffix || '{P}' || prefix || '{M}' || middle END AS output
FROM parts
"""

#: From (form, output): the text.  The leading sentinel is skipped, the second ends the first part, the middle's ends the second.
_RESTORED = """
SELECT * EXCLUDE (body, first, rest, second),
    CASE form WHEN 'plain' THEN output WHEN 'psm' THEN first || substr(rest, second + {m}) || substr(rest, 1, second - 1) ELSE substr(rest, 1, second - 1) || substr(rest, second + {m}) || first END AS restored
FROM (
    SELECT *, strpos(rest, '{M}') AS second
    FROM (
        SELECT *, substr(body, 1, strpos(body, CASE form WHEN 'psm' THEN '{S}' ELSE '{P}' END) - 1) AS first,
            substr(body, strpos(body, CASE form WHEN 'psm' THEN '{S}' ELSE '{P}' END) + CASE form WHEN 'psm' THEN {s} ELSE {p} END) AS rest
        FROM (SELECT *, CASE form WHEN 'psm' THEN substr(output, {p} + 1) WHEN 'spm' THEN substr(output, {s} + 1) END AS body FROM {source})
    )
)
"""

FORMS = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def _names() -> dict[str, object]:
    return {"P": PREFIX, "S": SUFFIX, "M": MIDDLE, "p": len(PREFIX), "s": len(SUFFIX), "m": len(MIDDLE)}


def _connect() -> duckdb.DuckDBPyConnection:
    return duckdb.connect(":memory:", config={"threads": 1, "temp_directory": ""})


def _lots(batches):
    for lot in slices(batches, 1024, LOT_BYTES):
        yield pa.Table.from_batches([lot])


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM, digests: bool = False) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output of each document; with
    ``digests``, instead of the output, output_sha256 and, of the text rebuilt from it, restored_sha256."""
    cut = _CUT.format(**_names(), seed=int(seed), rate=int(rate), spm=int(spm), **{f"h{i}": _HASH.format(at=8 * i - 7) for i in (1, 2, 3, 4)})
    kept = "doc_id, n, form, prefix_chars, middle_chars, "
    if digests:
        ask = f"SELECT {kept} sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM ({_RESTORED.format(source='cut', **_names())})"
    else:
        ask = f"SELECT {kept} output FROM cut"

    def run(batches):
        db = _connect()
        for lot in _lots(batches):
            db.register("batch", lot)
            db.execute(cut)
            yield from db.sql(ask).to_arrow_table().to_batches()
            db.execute("DROP TABLE cut")
            db.unregister("batch")

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"{FORMS}, " + ("output_sha256 string, restored_sha256 string" if digests else "output string"))


def restore(transformed: DataFrame) -> DataFrame:
    """doc_id and text of rows of ``fill_in_middle``, from form and output alone; a null
    output gives a null text."""
    ask = f"SELECT doc_id, restored AS text FROM ({_RESTORED.format(source='batch', **_names())})"

    def run(batches):
        db = _connect()
        for lot in _lots(batches):
            db.register("batch", lot)
            yield from db.sql(ask).to_arrow_table().to_batches()
            db.unregister("batch")

    return transformed.select("doc_id", "form", "output").mapInArrow(run, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(spread(documents(spark, sf_dir)), digests=True)


#: The same by substrings of the text; the restored text is the text.
ORACLE_SQL = f"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS h
    FROM documents
), hashes AS (
    SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM drawn
), formed AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR t LIKE '%<P>%' OR t LIKE '%<S>%' OR t LIKE '%<M>%' OR h3 % 100 >= {RATE} THEN 'plain' WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form
    FROM hashes
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t
        WHEN 'psm' THEN '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
        ELSE '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM formed
"""
