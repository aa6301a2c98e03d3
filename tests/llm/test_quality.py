import re
from collections import Counter

import numpy as np
import zstandard
from llm_fixtures import SF_MID, SF_SMALL, docs_of  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import quality_pu, quality_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    spans = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + j for i in range(len(words) - 7) if spans[tuple(words[i : i + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), failed


EDGE = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "a b c d e f g h " * 3),
    (5, "x y   z\x1cw\x85 " * 10),
    (6, "one line\none line\n one line\n\n\none line "),
    (7, "word " * 30_000),
    (None, "#*$%&|<> a é ü 日本"),
    (7, "word " * 30_000),
]


def test_base_counts_equal_brute_force(spark, docs_of):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + [(10_000 + i, t) for i, (_, t) in enumerate(EDGE)]
    got = {r.doc_id: r for r in quality_rules.rules(docs_of(rows)).collect()}
    for doc, text in rows:
        r = got[doc]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_base(text), (doc, text and text[:80])
        assert not (r.base_failed and r.kept)


def test_bands(docs_of):
    rng = np.random.default_rng(0)
    plain = " ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(3000))
    noise = " ".join("".join(map(chr, rng.integers(33, 2000, 40))) for _ in range(400))
    loop = " ".join(f"tick{i % 5} {i}" for i in range(4000))
    bands = quality_rules.Bands()
    packer = zstandard.ZstdCompressor(level=bands.level)
    verdict = lambda t: quality_rules.judge(t.encode(), packer, bands)[-1]
    assert verdict(plain)
    assert not verdict("buy now " * 4000)
    assert not verdict("".join(map(chr, rng.integers(0x4E00, 0x9FFF, 20_000))))
    assert verdict("") and verdict("short")
    got = {r.doc_id: r.kept for r in quality_rules.rules(docs_of([(1, plain), (2, noise), (3, loop), (4, None)]).withColumn("kept", F.lit(1))).collect()}
    assert got[1] and not got[4]


def test_the_rest_of_a_text_is_judged():
    rng = np.random.default_rng(3)
    plain = " ".join("".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(3000)).encode()
    spam = " ".join(f"buy {i}" for i in range(1, 600)).encode()
    bands = quality_rules.Bands()
    packer = zstandard.ZstdCompressor(level=bands.level)
    for size in (3000, 3900, 4095):
        whole, top, parts, bad, kept = quality_rules.judge(plain[:4096] + (spam * 2)[:size], packer, bands)
        assert 1.3 <= whole <= 5 and (parts, bad, kept) == (2, 1, False) and top > 4, size
        assert quality_rules.judge(plain[: 4096 + size], packer, bands)[2:] == (2, 0, True)
    # by bytes: a bad rest of less than a quarter stays, and one too short for a band is judged by the text's last chunk
    assert quality_rules.judge(plain[: 4 * 4096] + spam[:3900], packer, bands)[2:] == (5, 1, True)
    loop = b"again and again " * 256
    assert quality_rules.judge(plain[:4096] * 4 + loop + loop[:200], packer, bands)[2:4] == (6, 2)
    assert quality_rules.judge(plain[:4000], packer, bands)[1:] == (0.0, 0, 0, True)


def test_clean_documents_are_kept(spark):
    got = quality_rules.rules(spark.read.parquet(f"{SF_MID}/documents.parquet"))
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").where("quality = 1").select(F.col("doc_id").alias("id"))
    row = got.join(labels, F.col("doc_id") == F.col("id")).where("not base_failed").agg(F.avg(F.col("kept").cast("double")).alias("kept")).first()
    assert row.kept >= 0.99


def test_quality_scores_on_held_out_rows(spark):
    got = queries.op2_quality_classifier(spark, SF_MID)
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet").select(F.col("doc_id").alias("id"), "quality")
    rows = got.join(labels, F.col("doc_id") == F.col("id")).where("held_out").toPandas()
    high, low = rows[rows.quality == 1].score, rows[rows.quality == 0].score
    auc = np.mean([(h > low).mean() + 0.5 * (h == low).mean() for h in high])
    assert auc >= 0.85
    assert ((rows.predicted == 1) == (rows.quality == 1)).mean() >= 0.9
    assert got.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()
    assert got.where("score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").count() == 0


def test_quality_edge_rows(spark, docs_of):
    docs = docs_of([(i, f"some plain text number {i} with a few words of its own.") for i in range(60)] + EDGE[:8])
    model = quality_pu.fit(docs, docs.select("doc_id").where("doc_id % 2 = 0"))
    got = quality_pu.predict(docs.withColumn("score", F.lit("x")), model)
    assert got.count() == 68 and got.where("score is null or score < 0 or score > 1").count() == 0
    nothing = quality_pu.fit(docs, docs.select("doc_id").where("false"))
    assert {r.score for r in quality_pu.predict(docs, nothing).collect()} == {0.5}
    assert quality_pu.predict(docs_of([]), model).count() == 0


def test_prior_estimate():
    rng = np.random.default_rng(1)
    pos = rng.normal(2, 1, 4000)
    unl = np.where(rng.random(8000) < 0.6, rng.normal(2, 1, 8000), rng.normal(-2, 1, 8000))
    assert abs(quality_pu.estimate_prior(pos, unl) - 0.6) < 0.06


def test_pu_columns_of_any_name_and_a_bounded_sample(docs_of, monkeypatch):
    rows = [(i % 40 if i % 3 else None, f"words of text {i} and some more " * 3) for i in range(900)]
    docs = docs_of(rows).withColumns({c: F.lit(1) for c in ("id", "pos", "low", "kind", "key", "n", "score", "_kind")})
    seen = []
    monkeypatch.setattr(quality_pu, "train", lambda pos, unl, p: seen.append((len(pos[0]), len(unl[0]))) or quality_pu.Model())
    model = quality_pu.fit(docs, docs.where("doc_id < 20").select("doc_id"), quality_pu.Params(n_pos=6, n_unl=9))
    # an id many rows share gives one text
    assert seen == [(6, 9)]
    assert quality_pu.predict(docs, model).count() == 900


def test_pu_risk_and_gradient_by_finite_differences():
    rng = np.random.default_rng(2)
    pos, unl = rng.normal(1, 1, (30, 4)), rng.normal(0, 1, (50, 4))
    prior = 0.3

    def risk(w):
        sig = lambda z: 1 / (1 + np.exp(-z))
        up, uu = sig(-(pos @ w)).mean(), sig(unl @ w).mean()
        return prior * up + max(0.0, uu - prior * sig(pos @ w).mean())

    w0, b0 = quality_pu._descend(pos, unl, prior, quality_pu.Params(epochs=30, batch=80, l2=0.0, runs=1), np.random.default_rng(1))
    w = np.append(w0, b0)
    pos, unl = (np.column_stack([x, np.ones(len(x))]) for x in (pos, unl))
    start = risk(np.zeros(5))
    assert risk(w) < start - 0.02
    # no small step in any direction gains much more
    steps = [risk(w + 0.02 * d) for d in np.vstack([np.eye(5), -np.eye(5)])]
    assert min(steps) > risk(w) - 0.01
