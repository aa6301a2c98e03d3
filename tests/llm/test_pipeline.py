import random

import corpus_pipeline as pipeline
from llm_fixtures import SF_MID, SF_SMALL, docs_of, sf_of  # noqa: F401
from pyspark.sql import functions as F
from test_decontamination import distance
from test_simhash import brute_components, brute_print

from pulsegrid.llm import decontamination, mixing, packing
from pulsegrid.llm.common import materialize


def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for _, stage in pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], sf_dir), "test"))
    return out


def test_stages_equal_brute_force(spark):
    raw, lang, unique, clean, mix, rows = stages(spark, SF_SMALL)
    for x in (lang, unique, clean, mix):
        assert x.columns == raw.columns
    texts = {r.doc_id: r.text for r in raw.collect()}
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert set(ids(lang)) <= set(texts) and len(ids(lang)) >= 0.97 * len(texts)
    comp = brute_components({d: brute_print(texts[d]) for d in ids(lang)}, 2)
    assert ids(unique) == sorted(set(comp.values()))
    items = [decontamination.tokens(r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    for d in set(ids(unique)) - set(ids(clean)):
        words = decontamination.tokens(texts[d])
        assert any(len(set(x) & set(words)) >= 0.6 * len(set(x)) and distance(x, words) <= 0.2 * len(x) for x in items)
    kept = {d: " " + " ".join(decontamination.tokens(texts[d])) + " " for d in ids(clean)}
    assert not any(" " + " ".join(x) + " " in t for x in items for t in kept.values())
    taken = {r.doc_id: r.taken // r["size"] if r["size"] else 0 for r in mixing.mix(clean).collect()}
    assert ids(mix) == sorted(d for d, n in taken.items() for _ in range(n))
    coder = packing.Encoder(packing.VOCAB)
    back = {}
    for r in rows.collect():
        for doc, start, a, z in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            back.setdefault(doc, []).append((start, packing.matrix(r.ids)[a:z].tolist()))
    for d, n in taken.items():
        if n:
            want = coder.plain.encode_ordinary(texts[d])
            assert sorted(back[d]) == sorted((at, want[at : at + size]) for at, size in packing.pieces_of(len(want), 2048) for _ in range(n))


def test_odd_rows(spark, sf_of, docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("the of and house garden river stone bird".split()) for _ in range(60)), "en", rng.choice("ab")) for i in range(60)]
    rows += [(100 + i, " ".join(rng.choice("der die das und haus garten fluss stein".split()) for _ in range(60)), "de", "c") for i in range(60)]
    rows += [(500, None), (501, ""), (None, rows[0][1], None, None), (3, rows[3][1], "en", "a"), (502, "the house " * 40_000, "en", "a")]
    docs = docs_of(rows).withColumn("fp", F.lit("x")).withColumn("_copies", F.lit(1))
    bench = spark.createDataFrame([(1, rows[5][1])], "item_id long, text string")
    sf = sf_of(docs, benchmark=bench)
    got = stages(spark, sf)
    assert all(x.columns == docs.columns for x in got[1:5])
    assert {500, 501} & {r.doc_id for r in got[1].collect()} == set()
    assert 5 not in {r.doc_id for r in got[3].collect()}
    assert got[2].where("doc_id = 3").count() == 1
    assert pipeline.run(spark, sf).columns == got[5].columns
    assert all(x.count() == 0 for x in stages(spark, sf_of(docs.where("false"), benchmark=bench)))


def test_pipeline_is_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run
    assert [n for n in entry.queries() if n.startswith("op")] == sorted((n for n in entry.queries() if n.startswith("op")), key=lambda n: int(n[2:].split("_")[0]))
    assert len([n for n in entry.queries() if n.startswith("op")]) == 13
