"""WARC archives and a globally ordered capture index.

Writing: one record a capture. Equal payloads of at least ``min_payload`` bytes are stored
once: the capture with the smallest id is a ``response``, the others are ``revisit`` records
that name it. Spark's own text writer makes the files: every record ends with two line
breaks, which is the writer's line separator, so tasks are committed, retried and stored
(any Hadoop file system) like every other Spark output.

Reading: each archive (``binaryFile``) is parsed by Content-Length and every payload digest
is verified; a wrong one raises.

Index: external merge. The captures of each archive become a locally sorted run (URL key, timestamp, id,
archive, offset); runs are stored in blocks of ``BLOCK`` rows that know their first key. Key ranges are cut at
sampled keys, so a URL with a third of all captures is spread over ranges. A range reads its blocks
in the order of their first keys, which is the order in which a merge needs them: a loser tree over the blocks that are
open, at most one a run, gives every row below the first key of the next block. What a task holds depends on the number of
runs, not on the rows of its range; beyond ``FAN_IN`` runs, groups of about half as many are merged into longer runs first. Spark's
sort (which spills) brings the blocks in order. Ranges know how often their first URL occurs before them, so
``history`` numbers the captures of a URL over all ranges.

Defined results: a null payload is empty; a null URL has no target header and an empty URL
key; null ids lose against every id when a response is chosen and have no id header; rows that
repeat the smallest id of a payload are all responses; no rows, no archives, an empty index.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import map_batches, materialize
from pulsegrid.session import shared_dir

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: str) -> Column:
    """SHA-1 of a string column as upper-case base32: 5 hexadecimal digits make 4 characters."""
    return F.expr(
        f"array_join(transform(sequence(0, 31), i -> substr('{BASE32}', 1 + (shiftright(cast(conv(substr(sha1({data}), 1 + 5 * cast(floor(i / 4) as int), 5), 16, 10) as int), 15 - 5 * (i % 4)) & 31), 1)), '')"
    )


def captures(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """``pages(page_id, url, html)`` -> one row a capture with its digest, record type and the response it refers to."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")).withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", base32_sha1("payload"))
    first = pages.select("page_id", F.coalesce("html", F.lit("")).alias("payload")).select("page_id", base32_sha1("payload").alias("_digest")).groupBy("_digest").agg(F.min("page_id").alias("first"))
    again = (F.col("bytes") >= min_payload) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, F.col("digest") == F.col("_digest")).select("page_id", "url", "payload", "bytes", "digest", F.when(again, F.col("first")).alias("refers_to"), again.alias("again"))


def _record_id(page_id: str) -> str:
    return f"concat('<urn:uuid:', regexp_replace(md5(concat('page:', coalesce(cast({page_id} as string), 'null'))), '(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})', '$1-$2-$3-$4-$5'), '>')"


def write_archives(found: DataFrame, path: str, records: int = 2000) -> None:
    """Write ``captures`` as gzipped WARC files of at most ``records`` records."""
    when = "date_format(timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, pmod(coalesce(page_id, 0), 1000000000)), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    http = "concat('HTTP/1.1 200 OK\\r\\nContent-Type: text/html; charset=utf-8\\r\\nContent-Length: ', bytes, '\\r\\n\\r\\n')"
    block = f"if(again, {http}, concat({http}, payload))"
    head = f"""concat_ws('\\r\\n', 'WARC/1.1', concat('WARC-Type: ', if(again, 'revisit', 'response')), concat('WARC-Record-ID: ', {_record_id('page_id')}),
        concat('WARC-Date: ', {when}), concat('WARC-Target-URI: ', regexp_replace(url, '[\\\\x00-\\\\x20\\\\x7f]', '%20')), 'Content-Type: application/http; msgtype=response',
        concat('WARC-Payload-Digest: sha1:', digest), if(again, 'WARC-Profile: {REVISIT}', null), if(again, concat('WARC-Refers-To: ', {_record_id('refers_to')}), null),
        concat('X-Page-Id: ', page_id), concat('X-Refers-To-Page: ', refers_to), concat('Content-Length: ', octet_length(block)))"""
    value = found.withColumn("block", F.expr(block)).select(F.expr(f"concat({head}, '\\r\\n\\r\\n', block)").alias("value"))
    value.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records).text(path)


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers in lower case, block) of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {at}")
        head = {k.lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
        size = int(head["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
            raise ValueError(f"cut record at {at}")
        yield at, head, block
        at = end + 8 + size


def url_key(url: str) -> str:
    """Sort-friendly key: host labels reversed, then the lower-cased path and query without a fragment."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?(?:[^/@?#]*@)?([^/:?#]*)(?::\d+)?([^#]*)", url)
    host = m[1].lower().removeprefix("www.")
    return ",".join(reversed(host.split("."))) + ")" + (m[2].lower() or "/") if host else m[2].lower()


RUN_FIELDS = ["url_key", "timestamp", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "run", "offset"]
RUN_KINDS = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
RUN_SCHEMA = "url_key string, timestamp string, page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, run string, offset long"

#: Rows of a run that a merge takes in at once, a power of two.
BLOCK = 256
#: Runs that are merged at once.
FAN_IN = 256
#: Keys that are drawn for a range when the ranges are cut, and blocks a range has at least on average; only the ranges' number
#: and balance depend on it.
DRAWN = 20

KEY_FIELDS = ["url_key", "timestamp", "page_id", "run", "offset"]
KEY_KIND = pa.struct([(f, RUN_KINDS[RUN_FIELDS.index(f)]) for f in KEY_FIELDS])
#: A row's merge run, its place there and the first key of its block.
SOURCE_FIELDS, SOURCE_KINDS = ["source", "place", "block"], [pa.string(), pa.int64(), KEY_KIND]
SOURCE_SCHEMA = RUN_SCHEMA + ", source string, place long, block struct<url_key: string, timestamp: string, page_id: long, run: string, offset: long>"


def _key(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[7], row[8]


def _block_key(row: tuple) -> dict:
    return {f: row[RUN_FIELDS.index(f)] for f in KEY_FIELDS}


def _ordered(key: dict) -> tuple:
    """A block key as ``_key`` of its first row."""
    return key["url_key"], key["timestamp"], key["page_id"] is not None, key["page_id"] or 0, key["run"], key["offset"]


def _entry(run: str, at: int, head: dict[str, str], block: bytes) -> tuple:
    top, _, payload = block.partition(b"\r\n\r\n")
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?i)content-length: (\d+)", top)[1])
    if head["warc-type"] == "response":
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {head['warc-record-id']} in {run} does not match its digest")
    when = datetime.strptime(head["warc-date"], "%Y-%m-%dT%H:%M:%SZ").strftime("%Y%m%d%H%M%S")
    number = lambda name: int(head[name]) if name in head else None
    return url_key(head.get("warc-target-uri", "")), when, number("x-page-id"), head["warc-type"], size, digest, number("x-refers-to-page"), run, at


def _table(rows: list[tuple], fields=RUN_FIELDS, kinds=RUN_KINDS) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=fields)


def read_runs(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """Each archive under ``path`` as a run: its captures sorted by URL key, timestamp and id; ``place`` counts within the run,
    ``block`` is the key of the first row of a row's block."""

    def run(batches):
        for b in batches:
            for name, data in zip(b.column("path").to_pylist(), b.column("content")):
                name = name.rsplit("/", 1)[-1]
                rows = sorted((_entry(name, *x) for x in parse(gzip.decompress(data.as_py()))), key=_key)
                yield _table([(*r, name, i, _block_key(rows[i - i % block])) for i, r in enumerate(rows)], RUN_FIELDS + SOURCE_FIELDS, RUN_KINDS + SOURCE_KINDS)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path).select("path", "content")
    return map_batches(files, run, SOURCE_SCHEMA)


def loser_merge(runs: list[list], key, until=None, at: list[int] | None = None) -> Iterator:
    """Merge sorted runs; each step replays the one path of the loser tree that the last winner came from.

    Ends before the first key that is not below ``until``; ``at`` holds the places the runs are read from, and is moved on."""
    k = len(runs)
    if k == 0:
        return
    at = [0] * k if at is None else at
    done = (1,)
    now = [(0, key(r[i])) if i < len(r) else done for r, i in zip(runs, at)]
    end = done if until is None else (0, until)
    tree = [0] * k  # losers; tree[0]: the winner
    up = [0] * k + list(range(k))
    for node in range(k - 1, 0, -1):
        a, b = up[2 * node], up[2 * node + 1]
        up[node], tree[node] = (a, b) if now[a] <= now[b] else (b, a)
    tree[0] = up[1] if k > 1 else 0
    while now[win := tree[0]] < end:
        row = runs[win][at[win]]
        at[win] += 1
        yield row
        now[win] = (0, key(runs[win][at[win]])) if at[win] < len(runs[win]) else done
        node = (win + k) // 2
        while node:
            if now[tree[node]] < now[win]:
                win, tree[node] = tree[node], win
            node //= 2
        tree[0] = win


def merge_blocks(blocks: Iterator[tuple[tuple, list]], key) -> Iterator:
    """Merge runs from their blocks ``(lower bound, rows)``, which come by ascending bounds; a block is in memory while its rows are due."""
    held: list[list] = []
    at: list[int] = []
    ahead = next(blocks, None)
    while ahead is not None:
        held.append(ahead[1])
        at.append(0)
        ahead = next(blocks, None)
        yield from loser_merge(held, key, ahead and ahead[0], at)
        left = [i for i, rows in enumerate(held) if at[i] < len(rows)]
        held, at = [held[i] for i in left], [at[i] for i in left]


def range_bounds(runs: DataFrame, ranges: int) -> list[dict]:
    """Ascending keys that cut the runs into at most ``ranges`` ranges: quantiles of the ``DRAWN * ranges`` rows with the lowest hashes.

    Any row may be drawn: the first keys of short runs are all low."""
    drawn = runs.select(*KEY_FIELDS).orderBy(F.xxhash64(*KEY_FIELDS)).limit(DRAWN * ranges).collect()
    keys = sorted((r.asDict() for r in drawn), key=_ordered)
    ranges = min(ranges, len(keys))
    return [keys[len(keys) * i // ranges] for i in range(1, ranges)]


def _in_ranges(runs: DataFrame, bounds: list[dict]) -> DataFrame:
    """The runs with the number of each row's range (``part``)."""
    cuts = [_ordered(b) for b in bounds]

    def run(batches):
        for b in batches:
            keys = zip(*(b.column(f).to_pylist() for f in KEY_FIELDS))
            part = [bisect_right(cuts, (url, when, page is not None, page or 0, name, at)) for url, when, page, name, at in keys]
            yield b.append_column("part", pa.array(part, pa.int32()))

    return map_batches(runs, run, runs.schema.simpleString().removeprefix("struct<").removesuffix(">") + ",part:int")


def _earlier(runs: DataFrame, bounds: list[dict]) -> list[int]:
    """For every bound, how many captures of its URL lie in the ranges before it. Collects a row for every range a bound's URL is in."""
    urls = sorted({b["url_key"] for b in bounds})
    if not urls:
        return []
    few = runs.sparkSession.createDataFrame([(u,) for u in urls], "url_key string")
    found = _in_ranges(runs.join(F.broadcast(few), "url_key", "left_semi"), bounds).groupBy("url_key", "part").count().collect()
    total, seen = {}, {}
    for r in sorted(found, key=lambda r: r.part):
        seen.setdefault(r.url_key, []).append((r.part, r["count"]))
    for url, parts in seen.items():
        n = 0
        for part, count in parts:
            total[url, part], n = n, n + count
    # a bound is a capture of the range it opens
    return [total[b["url_key"], i + 1] for i, b in enumerate(bounds)]


def _sets(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[tuple[tuple[int, int], Iterator[tuple[tuple, list]]]]:
    """((group, part), its blocks) of a sorted partition; the blocks of a set must be read before the next set."""

    def blocks():
        now, bound, rows = None, None, []
        for b in batches:
            cells = zip(b.column("group").to_pylist(), b.column("part").to_pylist(), b.column("source").to_pylist(), b.column("place").to_pylist())
            for i, (row, (group, part, source, place)) in enumerate(zip(zip(*(b.column(f).to_pylist() for f in RUN_FIELDS)), cells)):
                mine = (group, part, source, place // block)
                if mine != now:
                    if rows:
                        yield now[:2], bound, rows
                    now, bound, rows = mine, _ordered(b.column("block")[i].as_py()), []
                rows.append(row)
        if rows:
            yield now[:2], bound, rows

    every = blocks()
    ahead = next(every, None)

    def of(name):
        nonlocal ahead
        while ahead is not None and ahead[0] == name:
            mine, ahead = ahead[1:], next(every, None)
            yield mine

    while ahead is not None:
        name = ahead[0]
        yield name, of(name)


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def _longer_runs(runs: DataFrame, bounds: list[dict], groups: int, label: str, block: int) -> DataFrame:
    """One pass: the runs of each of ``groups`` groups merged into one, range by range."""
    grouped = _in_ranges(runs, bounds).withColumn("group", F.pmod(F.xxhash64("source"), F.lit(groups)).cast("int"))

    def run(batches):
        for (group, part), blocks in _sets(batches, block):
            at = part << 40
            for rows in _chunks(merge_blocks(blocks, _key), block):
                first = _block_key(rows[0])
                yield _table([(*r, f"{label}{group}", at + i, first) for i, r in enumerate(rows)], RUN_FIELDS + SOURCE_FIELDS, RUN_KINDS + SOURCE_KINDS)
                at += block

    return map_batches(grouped.repartition("group", "part").sortWithinPartitions("group", "part", "block", "place"), run, SOURCE_SCHEMA)


def merge_runs(runs: DataFrame, fan_in: int = FAN_IN, ranges: int | None = None, block: int = BLOCK) -> DataFrame:
    """The stored runs merged: partitions are ascending key ranges, rows inside are in order; ``history`` numbers the captures of a URL.

    A row's order is its URL key, timestamp, id, archive and offset, however many passes there are."""
    spark = runs.sparkSession
    rows, count = runs.agg(F.count(F.lit(1)), F.count_distinct("source")).first()
    ranges = ranges or max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // (DRAWN * block)))
    bounds, again = range_bounds(runs, ranges), 0
    while count > fan_in:
        groups = -(-2 * count // fan_in)
        if groups >= count:
            break
        runs = materialize(_longer_runs(runs, bounds, groups, f"{again}:", block), "warc_runs")
        count, again = groups, again + 1
    before = _earlier(runs, bounds)

    def run(batches):
        for (_, part), blocks in _sets(batches, block):
            last, n = (bounds[part - 1]["url_key"], before[part - 1]) if part else (None, 0)
            for rows in _chunks(merge_blocks(blocks, _key), 10_000):
                out = []
                for row in rows:
                    last, n = row[0], n + 1 if row[0] == last else 1
                    out.append((*row, n))
                yield _table(out, [*RUN_FIELDS, "history"], [*RUN_KINDS, pa.int64()])

    placed = _in_ranges(runs, bounds).withColumn("group", F.lit(0)).repartitionById(len(bounds) + 1, "part")
    return map_batches(placed.sortWithinPartitions("part", "block", "place"), run, RUN_SCHEMA + ", history long")


def archive_and_index(pages: DataFrame, path: str | None = None, min_payload: int = 0, records: int = 2000) -> DataFrame:
    """Write ``pages`` as WARC archives (below ``spark.checkpoint.dir`` if no path is given), read them back, return the merged index."""
    spark = pages.sparkSession
    path = path or shared_dir(spark, "warc", unique=True)
    write_archives(captures(pages, min_payload), path, records)
    return merge_runs(materialize(read_runs(spark, path), "warc"))


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, strlen(payload) AS payload_bytes,
         list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::INT >> (15 - 5 * (i % 4))) & 31), 1) for i in range(32)], 'string_agg', '') AS payload_digest
  FROM p),
f AS (SELECT payload_digest, min(page_id) AS first FROM d GROUP BY 1)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM d JOIN f USING (payload_digest)
"""
