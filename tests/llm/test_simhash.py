import re

import xxhash
from llm_fixtures import SF_SMALL, docs_of, sf_of  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import queries, simhash
from pulsegrid.llm.components import components


def brute_print(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(len(words) - 2)] or [xxhash.xxh64_intdigest(" ".join(words).encode(), 42)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    """prints: {doc: fingerprint} -> {doc: smallest doc reachable}"""
    values = sorted(set(prints.values()))
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    least = {}
    for d, v in prints.items():
        least[find(v)] = min(d, least.get(find(v), d))
    return {d: least[find(v)] for d, v in prints.items()}


EDGE = [(900_001, None), (900_002, ""), (900_003, " \n"), (900_004, "one"), (900_005, "ONE two"), (900_006, "one TWO"), (900_007, "É é x"), (900_008, "same " * 50_000), (900_009, "same " * 49_999)]


def test_equals_brute_force(spark, sf_of):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + EDGE
    got = queries.op8_simhash(spark, sf_of(rows)).collect()
    prints = {d: brute_print(t) for d, t in rows}
    want = brute_components(prints, 2)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{prints[d]:016x}", want[d]) for d, _ in rows}


def test_links_of_any_radius(spark):
    base = [0, 1, 3, 7, 1 << 63, (1 << 63) | 1, 0x0F0F, 0x0F0E, 0x0F1E, 0xFFFF << 20]
    signed = [b - (1 << 64) if b >> 63 else b for b in base]
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    for radius in (1, 2, 3):
        found = simhash.links(df, radius)
        roots = {r.vertex: r.root for r in components(found).collect()}
        root_of = [roots.get(s, s) for s in signed]
        want = brute_components(dict(enumerate(base)), radius)
        for i in range(len(base)):
            for j in range(len(base)):
                assert (root_of[i] == root_of[j]) == (want[i] == want[j]), (radius, base[i], base[j])


def test_repeated_rows_and_null_ids(docs_of):
    rows = [(5, "a b c d e"), (5, "a b c d e"), (3, "a b c d e"), (None, "x y z"), (None, "x y z"), (9, "k l m n")]
    docs = docs_of(rows).withColumn("root", F.lit("r")).withColumn("component_id", F.lit(0)).withColumn("fp", F.lit(1))
    got = simhash.near_duplicates(docs.select("doc_id", "text")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, -1), (3, 3), (5, 3), (5, 3), (9, 9)]
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 9]
    assert simhash.keep_first(docs.where("false")).count() == 0


def test_first_rows_with_null_and_shared_ids(docs_of):
    texts = [f"t{k} u{k} v{k} w{k} x{k}" for k in range(12)]
    # every text is a component: of null ids only, of one id shared by all of them, or of both
    rows = [(None, t) for t in texts for _ in range(3)] + [(7, t) for t in texts[6:]] + [(7, "one more text of it")] * 2 + [(8, texts[11]), (4, texts[10])]
    kept = sorted((r.doc_id or 0, r.text) for r in simhash.keep_first(docs_of(rows)).collect())
    assert kept == sorted([(0, t) for t in texts[:6]] + [(7, t) for t in texts[6:10]] + [(4, texts[10]), (7, texts[11]), (7, "one more text of it")])


def test_first_row_does_not_depend_on_the_order(docs_of):
    rows = [(None, "a b c d", "en", s) for s in "pqrst"] + [(None, "A b c D", None, "p"), (2, "k l m", None, "x"), (2, "k l m", "x", None)]
    got = {tuple(sorted(map(str, simhash.keep_first(docs_of(x).withColumn("m", F.create_map(F.lit("k"), "source"))).drop("m").collect()))) for x in (rows, rows[::-1])}
    assert len(got) == 1 and len(next(iter(got))) == 2


def test_one_row_stays_of_repeats_of_the_first(docs_of):
    assert simhash.keep_first(docs_of([(1, "p q r s")] * 4)).count() == 1


def test_long_chain_of_links(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in components(edges).collect()} == {0}
    assert components(edges.where("false")).count() == 0
