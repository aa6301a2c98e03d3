import random

import numpy as np
from llm_fixtures import SF_MID, docs_of  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import decontamination as deco
from pulsegrid.llm import queries


def words(rng, n, size=3000):
    return [f"w{int(rng.paretovariate(0.6)) % size}x" for _ in range(n)]


def distance(a, b):
    """Plain edit distance of a to any passage of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def planted(rng):
    items = [words(rng, rng.randint(12, 60)) for _ in range(40)]
    docs = []
    for i in range(400):
        body = words(rng, rng.randint(0, 300))
        if i % 4 == 0:
            leak = list(items[i % 40])
            for _ in range(rng.randint(0, int(0.2 * len(leak)))):
                k = rng.randrange(len(leak))
                leak[k : k + 1] = rng.choice([[], ["edit"], [leak[k], "more"]])
            at = rng.randint(0, len(body))
            body = body[:at] + leak + body[at:]
        docs.append(body)
    return items, docs


def test_recall_and_precision_against_brute_force(spark, docs_of):
    items, docs = planted(random.Random(4))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edit_distance for r in deco.leaks(docs_of([(i, " ".join(d)) for i, d in enumerate(docs)]), bench).collect()}
    true = {(d, i): e for d, body in enumerate(docs) for i, x in enumerate(items) if len(set(x) & set(body)) >= 0.7 * len(set(x)) and (e := distance(x, body)) <= int(0.2 * len(x))}
    assert set(got) <= set(true) and all(got[k] == true[k] for k in got)
    assert len(true) >= 90 and len(got) >= 0.9 * len(true)
    assert {k for k, e in true.items() if e <= 1} <= set(got)


def test_infix_distance():
    rng = random.Random(1)
    for _ in range(200):
        a, b = [rng.randint(1, 4) for _ in range(rng.randint(1, 8))], [rng.randint(1, 4) for _ in range(rng.randint(0, 15))]
        assert deco.infix_distance(np.array(a), np.array(b, np.int64))[0] == distance(a, b)


def test_exact_leaks_of_the_tables(spark):
    norm = lambda t: " " + " ".join(deco.tokens(t)) + " "
    items = [(r.item_id, norm(r.text)) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    docs = [(r.doc_id, norm(r.text)) for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()]
    want = {(d, i) for d, t in docs for i, x in items if x in t}
    got = {(r.doc_id, r.item_id) for r in queries.op1_decontamination(spark, SF_MID).collect()}
    assert want and want <= got
    texts, bench = dict(docs), dict(items)
    assert all(distance(bench[i].split(), texts[d].split()) <= 0.2 * len(bench[i].split()) for d, i in got - want)


def test_edge_rows(spark, docs_of):
    item = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "too short"), (None, item + " eleven twelve")], "item_id long, text string")
    docs = docs_of([(1, None), (2, ""), (3, "!!"), (4, "x " * 60_000 + item.upper() + " y" * 60_000), (None, item), (4, "clean words only")]).withColumn("item_id", F.lit("clash"))
    got = sorted((r.doc_id or 0, r.item_id or 0, r.edit_distance) for r in deco.leaks(docs, bench).collect())
    assert got == [(0, 0, 2), (0, 1, 0), (0, 1, 0), (4, 0, 2), (4, 1, 0), (4, 1, 0)]
    kept = deco.clean(docs, bench)
    assert kept.columns == docs.columns and sorted((r.doc_id, (r.text or "")[:5]) for r in kept.collect()) == [(1, ""), (2, ""), (3, "!!"), (4, "clean")]
    assert deco.clean(docs, bench.where("false")).count() == 6 and deco.leaks(docs, bench.where("false")).count() == 0


def test_blocks_cover_the_benchmark(spark, docs_of, monkeypatch):
    monkeypatch.setattr(deco, "BLOCK", 7)
    items, docs = planted(random.Random(9))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    table = docs_of([(i, " ".join(d)) for i, d in enumerate(docs[:80])])
    hit = {r.doc_id for r in deco.leaks(table, bench).collect()}
    assert len(hit) >= 18 and {r.doc_id for r in deco.clean(table, bench).collect()} == set(range(80)) - hit


def test_short_items_are_found_word_by_word(spark, docs_of):
    bench = spark.createDataFrame([(1, "What is it?"), (2, "zeta"), (3, "一二三四五六"), (4, "what is it?"), (5, "six words and no more here")], "item_id long, text string")
    docs = docs_of([(1, "So WHAT, is it what is it"), (2, "zetas and beta"), (3, "前一二三四五六後"), (4, "一二三 四五 六"), (5, "what is that, it is"), (6, "is it"), (7, "no zeta-functions " * 2), (8, "six words and no more"), (9, None)])
    got = sorted((r.doc_id, r.item_id, r.edit_distance, r.end_word) for r in deco.leaks(docs, bench).collect())
    assert got == [(1, 1, 0, 4), (1, 4, 0, 4), (3, 3, 0, 7), (4, 3, 0, 6), (7, 2, 0, 2)]
    assert sorted(r.doc_id for r in deco.clean(docs, bench).collect()) == [2, 5, 6, 8, 9]


def test_blocks_share_one_pass(spark, docs_of, monkeypatch):
    monkeypatch.setattr(deco, "BLOCK", 5)
    items, docs = planted(random.Random(2))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    table = docs_of([(i, " ".join(d)) for i, d in enumerate(docs[:60])])
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    one = deco.clean(table, bench)
    assert count(one) == 1
    monkeypatch.setattr(deco, "PASS", 3)
    more = deco.clean(table, bench)
    assert count(more) == 3 and sorted(map(str, more.collect())) == sorted(map(str, one.collect()))
