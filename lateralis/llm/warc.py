"""Web archives: write captures as WARC records, read them back, and merge their sorted index runs.

Writing is one Spark job in the JVM: payload digests, one small aggregate of the digests that repeat, a
join of the pages with it (salted, so that a payload with a third of all rows is spread over many tasks),
and a gzip text sink whose line end is the record end, so that any file system Spark can write to serves. Each
file is sorted by URL key, time and page: a locally sorted capture run.

Reading parses the files, checks every payload against its digest and gives the index of the records. The
index is an external merge: it is range-partitioned by URL key, time and page, and each task merges the
runs it receives with a loser tree, so partitions in order, and rows within them, are the global history.

Defined results: a null html is an empty payload; a null url is ``urn:page:<page_id>``; payloads below
``least`` bytes are never revisits; of equal payloads the smallest page_id is the response, and so is each
repeated row of that page; control characters and spaces of a url are percent-encoded in headers.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lateralis.llm.registry import query, table
from lateralis.session import scratch_path

LEAST_BYTES = 100
SALTS = 16
RECORDS_PER_FILE = 2_000
END = "\r\n\r\n"
INDEX = (
    "url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, file string, offset long, length long"
)


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels reversed, then path and query, without scheme, ``www`` and fragment."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(url), "#.*$", ""), r"^[a-z][a-z0-9+.-]*://(www\d*\.)?", "")
    host, rest = F.regexp_extract(bare, r"^([^/?:]*)", 1), F.regexp_extract(bare, r"^[^/?:]*(?::\d+)?(.*)$", 1)
    return F.concat(F.concat_ws(",", F.reverse(F.split(host, r"\."))), F.lit(")"), rest)


def records(pages: DataFrame, least: int = LEAST_BYTES, captured: Column | None = None) -> DataFrame:
    """One WARC record per page, as text, with its sort key."""
    page = F.col("page_id").cast("long")
    url = F.regexp_replace(F.coalesce(F.col("url"), F.concat(F.lit("urn:page:"), page.cast("string"))), r"[\x00-\x20\x7f]", "%20")
    html = F.coalesce(F.col("html"), F.lit(""))
    when = captured if captured is not None else F.timestamp_seconds(F.lit(1_600_000_000) + F.coalesce(page, F.lit(0)))
    rows = pages.select(
        page.alias("page_id"), url.alias("url"), html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"),
        F.octet_length(html).cast("long").alias("bytes"), F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
    )
    repeated = (
        rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1").select(F.col("digest").alias("d"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(repeated, (F.col("digest") == F.col("d")) & (F.col("salt") == F.col("s")), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    payload = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    header = F.concat_ws(
        "\r\n", F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Date: "), F.col("captured")),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("X-Payload-Length: "), F.col("bytes")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("first"), F.lit(">"))),
        F.concat(F.lit("X-URL-Key: "), url_key(F.col("url"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload)),
    )
    return joined.select(
        url_key(F.col("url")).alias("url_key"), "captured", "page_id", F.concat(header, F.lit(END), payload).alias("value")
    )


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, captured: Column | None = None) -> None:
    """Write one or more archive files a task, each sorted by URL key, time and page."""
    runs = records(pages, least, captured).sortWithinPartitions("url_key", "captured", "page_id")
    runs.select("value").write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def parse(content: memoryview) -> Iterator[tuple[dict[str, str], memoryview, int, int]]:
    """(headers, payload, offset, length) of each record of an archive."""
    raw, at = bytes(content), 0
    while at < len(raw):
        cut = raw.index(b"\r\n\r\n", at)
        lines = raw[at:cut].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record at {at}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        begin = cut + 4
        end = begin + int(headers["Content-Length"])
        if raw[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} has no end")
        yield headers, content[begin:end], at, end + 4 - at
        at = end + 4


def _page(text: str) -> int | None:
    return int(text[len("<urn:page:"):-1]) if len(text) > len("<urn:page:>") else None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The index of all records, in the order of each file; fails on a payload that differs from its digest."""

    def index(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows = []
                raw = content.as_py()
                for headers, payload, offset, length in parse(memoryview(gzip.decompress(raw) if name.endswith(".gz") else raw)):
                    digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"]
                    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"{name}: payload at {offset} differs from its digest")
                    rows.append((
                        headers["X-URL-Key"], headers["WARC-Date"], _page(headers["WARC-Record-ID"]), int(headers["X-Payload-Length"]), digest,
                        kind, _page(headers["WARC-Refers-To"]) if kind == "revisit" else None, name.rsplit("/", 1)[-1], offset, length,
                    ))
                yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(index, INDEX)


_KINDS = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
_NAMES = [part.split()[0] for part in INDEX.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], _NAMES)


def merge_runs(runs: list[Iterator]) -> Iterator:
    """k-way merge of sorted iterators by a loser tree: one comparison a level for each item."""
    count = len(runs)
    heads = [next(run, None) for run in runs]
    if not count:
        return

    def beats(a: int, b: int) -> bool:
        if heads[a] is None or heads[b] is None:
            return heads[b] is None and (heads[a] is not None or a < b)
        return (heads[a], a) < (heads[b], b)

    losers = [-1] * count
    winner = -1
    for leaf in range(count):  # play each leaf up to the first empty seat
        rising, seat = leaf, (leaf + count) // 2
        while seat and losers[seat] >= 0:
            if beats(losers[seat], rising):
                losers[seat], rising = rising, losers[seat]
            seat //= 2
        if seat:
            losers[seat] = rising
        else:
            winner = rising
    while heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        rising, seat = winner, (winner + count) // 2
        while seat:
            if beats(losers[seat], rising):
                losers[seat], rising = rising, losers[seat]
            seat //= 2
        winner = rising


def merged_index(index: DataFrame) -> DataFrame:
    """The index rows in global order of URL key, time and page, by merging the runs of each key range."""

    def merge(batches):
        runs: dict[str, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                order = (row[0], row[1], -1 if row[2] is None else row[2], row[7], row[8])
                runs.setdefault(row[7], []).append((order, row))
        for rows in runs.values():  # a shuffle may deliver the blocks of one run in any order
            rows.sort(key=lambda r: r[0])
        out = []
        for _, row in merge_runs([iter(rows) for rows in runs.values()]):
            out.append(row)
            if len(out) == 5_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    return index.repartitionByRange("url_key", "captured", "page_id").mapInArrow(merge, INDEX)


def archive(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """Write all pages, read the archives back, and give the merged capture history."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, least)
    index = scratch_path(spark, "runs")
    read_archives(spark, path).write.parquet(index)
    return merged_index(spark.read.parquet(index))


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f""")
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive(table(spark, folder, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
