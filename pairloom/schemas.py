"""Explicit schemas of the relations; nothing is inferred from data."""

from pyspark.sql import types as T


_TYPES = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "short": T.ShortType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "array<float>": T.ArrayType(T.FloatType()),
}


def _struct(spec: str) -> T.StructType:
    """Of "name type, name type, ..."; no session is needed."""
    return T.StructType([T.StructField(*(n, _TYPES[k])) for n, k in (f.split(" ") for f in spec.split(", "))])


def _nested(*names: str, leaf: T.StructType) -> T.StructType:
    for n in reversed(names):
        leaf = T.StructType([T.StructField(n, leaf)])
    return leaf


_LINKS = T.StructType([T.StructField("Links", T.ArrayType(_struct("path string, url string, alt string")))])
#: One line of crawl metadata (JSON): links of one page and the page's address.
CRAWL = T.StructType(
    [
        T.StructField(
            "Envelope",
            T.StructType(
                [
                    *_nested("WARC-Header-Metadata", leaf=_struct("WARC-Target-URI string")).fields,
                    *_nested("Payload-Metadata", "HTTP-Response-Metadata", "HTML-Metadata", leaf=_LINKS).fields,
                ]
            ),
        )
    ]
)
CANDIDATE = _struct("sampleid long, url string, text string, license string, domain string, wat int, hash string, language string")
DATASET = _struct(
    "sampleid long, url string, text string, license string, domain string, wat int, status short, illegal boolean, hash string, modified timestamp, language string, width int, height int"
)
JOB = _struct("jobid string, status int, modified timestamp")
DOWNLOAD = _struct("sample_id long, path string, url string, text string, width int, height int, license string, language string, status int")
#: The legacy sink labels width as HEIGHT and height as WIDTH.
DOWNLOAD_CSV = _struct("SAMPLE_ID long, PATH string, URL string, TEXT string, HEIGHT int, WIDTH int, LICENSE string, LANGUAGE string, STATUS int")
SCORED = _struct("sample_id long, path string, url string, text string, width int, height int, license string, language string, status int, hash string, dropped boolean, nsfw string, similarity double")
DATAPOINTS = _struct("epoch double, en long, intl long, nolang long")
KEYS = _struct("key string")
AUDIO_LINK = _struct("url string, label string")
EMBEDDING = _struct("sample_id long, embedding array<float>")
