import base64
import gzip
import hashlib
import random

import pytest
from llm_fixtures import SF_SMALL  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import queries, warc

PAGES = "page_id long, url string, html string"


def brute(rows):
    first = {}
    for page, _, html in rows:
        h = html or ""
        if page is not None:
            first[h] = min(page, first.get(h, page))
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        least = first.get(html or "")
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if page == least else "revisit", None if page == least else least))
    return sorted(out, key=repr)


EDGE = [(1, "http://a.b/x", "same"), (2, None, "same"), (3, "https://www.A.b:8080/x?q#f", None), (4, "ftp://u:p@h/\n \tx", ""), (5, "x", "a\r\n\r\nWARC/1.1\r\n\r\nb"), (6, "", "é日本😀" * 20_000), (7, "http://a.b/x", "same"), (1, "http://a.b/x", "same"), (None, "http://n/", "only null"), (9, "http://a.b/x", "\r\n\r\n")]


@pytest.mark.parametrize("rows", [EDGE, EDGE[:1], []])
def test_round_trip(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, PAGES).withColumn("digest", F.lit("x")).withColumn("first", F.lit(0))
    got = warc.archive_and_index(pages, str(tmp_path / "w"), records=3).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute(rows)
    keys = [warc._key((r.url_key, r.timestamp, r.page_id, None, None, None, None, r.run, r.offset)) for r in got]
    assert keys == sorted(keys)


def test_archives_are_plain_warc(spark, tmp_path):
    warc.write_archives(warc.captures(spark.createDataFrame(EDGE, PAGES)), str(tmp_path / "w"), records=4)
    bodies = []
    for f in (tmp_path / "w").glob("*.txt.gz"):
        data = gzip.decompress(f.read_bytes())
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n")
        records = list(warc.parse(data))
        assert len(records) <= 4
        bodies += [b.partition(b"\r\n\r\n")[2] for _, h, b in records if h["warc-type"] == "response"]
    assert set(bodies) == {(h or "").encode() for _, _, h in EDGE}


def test_small_payloads_are_all_stored(spark):
    found = warc.captures(spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "longer"), (4, "d", "longer")], PAGES), min_payload=3).collect()
    assert {r.page_id for r in found if r.again} == {4}


def test_damage_is_noticed(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(warc.captures(spark.createDataFrame([(1, "a", "payload")], PAGES)), path)
    f = next((tmp_path / "w").glob("*.txt.gz"))
    f.write_bytes(gzip.compress(gzip.decompress(f.read_bytes()).replace(b"payload", b"payl0ad")))
    (tmp_path / "w" / f".{f.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_runs(spark, path).collect()


def test_loser_merge():
    rng = random.Random(3)
    for k in range(9):
        runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 12))) for _ in range(k)]
        assert list(warc.loser_merge(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def _blocks(runs, size):
    cut = [(r[i], r[i : i + size]) for r in runs for i in range(0, len(r), size)]
    return sorted(cut, key=lambda b: b[0])


def test_merge_of_blocks_holds_one_block_a_run():
    rng = random.Random(4)
    peak = {}
    for n in (200, 2000):
        runs = [sorted((rng.random(), k) for _ in range(n)) for k in range(7)]
        held, most = 0, 0

        def counted(blocks):
            nonlocal held, most
            for bound, rows in blocks:
                held += len(rows)
                most = max(most, held)
                yield bound, rows

        got = []
        for row in warc.merge_blocks(counted(_blocks(runs, 10)), lambda x: x):
            got.append(row)
            held -= 1
        assert got == sorted(x for r in runs for x in r)
        peak[n] = most
    assert peak[2000] <= 10 * (7 + 2) and peak[2000] <= peak[200] + 20  # ten times the rows, the same memory
    assert list(warc.merge_blocks(iter([]), lambda x: x)) == []


def test_bounds_below_the_first_row_of_a_block_are_enough():
    """Blocks that begin before a range are led by the key of their first row, which is not in the range."""
    runs = [sorted(random.Random(k).randint(0, 500) * 10 + k for _ in range(90)) for k in range(5)]
    inside = [(b, [x for x in rows if x >= 1234]) for b, rows in _blocks(runs, 8)]
    got = list(warc.merge_blocks(iter([b for b in inside if b[1]]), lambda x: x))
    assert got == sorted(x for r in runs for x in r if x >= 1234)


@pytest.mark.parametrize("fan_in,ranges", [(256, 1), (256, 7), (4, 5), (3, 8)])
def test_histories_are_global_in_any_number_of_passes(spark, tmp_path, fan_in, ranges):
    """A URL with a third of the captures, null ids and repeated rows; small blocks, several ranges and passes."""
    rng = random.Random(6)
    rows = [(rng.choice([i, i, i, 7, None]), "http://hot/" if i % 3 == 0 else f"http://u{rng.randint(0, 40)}/", f"text {i % 50}") for i in range(400)]
    warc.write_archives(warc.captures(spark.createDataFrame(rows, PAGES).repartition(10)), str(tmp_path / "w"), records=20)
    stored = warc.materialize(warc.read_runs(spark, str(tmp_path / "w"), block=4), "warc_test")
    assert stored.select("source").distinct().count() >= 20
    assert len(warc.range_bounds(stored, ranges)) == ranges - 1
    merged = warc.merge_runs(stored, fan_in, ranges, block=4).withColumn("at", F.spark_partition_id())
    got = merged.collect()
    shares = [r["count"] for r in merged.groupBy("at").count().collect()]
    assert len(shares) == ranges and max(shares) < 2.5 * len(rows) / ranges  # short runs too
    keys = [warc._key((r.url_key, r.timestamp, r.page_id, None, None, None, None, r.run, r.offset)) for r in got]
    assert keys == sorted(keys) and len(set(keys)) == len(keys) == len(rows)
    seen = {}
    for r in got:
        seen[r.url_key] = seen.get(r.url_key, 0) + 1
        assert r.history == seen[r.url_key]
    assert seen["hot)/"] == 134


def test_url_keys():
    assert warc.url_key("https://www.Example.com:80/A/b?X=1#top") == "com,example)/a/b?x=1"
    assert warc.url_key("http://user:pw@h.org") == "org,h)/"
    assert warc.url_key("") == ""


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, queries.op10_warc(spark, SF_SMALL).collect()), key=repr) == brute(rows)
