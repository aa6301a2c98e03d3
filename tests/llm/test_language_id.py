import numpy as np
from llm_fixtures import SF_MID, docs_of  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import language_id, queries
from pulsegrid.llm.common import held_out


def test_held_out_accuracy(spark):
    got = queries.op3_language_id(spark, SF_MID)
    lang = spark.read.parquet(f"{SF_MID}/documents.parquet").select(F.col("doc_id").alias("id"), "lang")
    row = got.join(lang, got.doc_id == F.col("id")).where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("acc"), F.count("*").alias("n")).first()
    assert row.n > 100 and row.acc >= 0.97
    assert got.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()


def test_edge_rows(docs_of):
    train = [(i, "the cat and the dog of this house " * 3, "en") for i in range(40)] + [(100 + i, "der hund und die katze von dem haus " * 3, "de") for i in range(40)]
    model = language_id.fit(docs_of(train))
    assert model.langs == ["de", "en"]
    rows = docs_of([(1, None), (2, ""), (3, "123 !! ..\n"), (4, "the dog " * 50_000), (None, "die katze und der hund"), (4, "the dog " * 50_000), (5, "a\0b the house")])
    got = {(r.doc_id, r.lang_pred): r for r in language_id.predict(rows.withColumn("score", F.lit("x")), model).collect()}
    assert {k for k in got if k[1] == "und"} == {(1, "und"), (2, "und"), (3, "und")}
    assert all(got[k].score == 0 and not got[k].accepted for k in got if k[1] == "und")
    assert (4, "en") in got and (None, "de") in got
    kept = language_id.accept(rows.withColumn("score", F.lit("x")), model)
    assert kept.columns == rows.columns + ["score"] and kept.where("doc_id = 4").count() == 2


def test_no_labels(docs_of):
    model = language_id.fit(docs_of([(1, "abc", None)]))
    assert [r.lang_pred for r in language_id.predict(docs_of([(1, "abc")]), model).collect()] == ["und"]
    assert language_id.predict(docs_of([]), model).count() == 0


def test_pieces_count_every_ngram_once(monkeypatch):
    text = "The quick brown fox, jumps over Ünïcode 12 and more words! " * 9
    whole = language_id.features([text], 1 << 12)[0]
    monkeypatch.setattr(language_id, "PIECE", 50)
    cut = language_id.features([text], 1 << 12)[0]
    # a piece may see a run's blank twice or not at all; letters inside words are counted once
    assert abs(int(whole[1].sum()) - int(cut[1].sum())) <= 0.05 * whole[1].sum()


def test_rejection_limit():
    score = np.array([0.5, 0.6, 0.7, 0.9, 0.95])
    assert language_id.rejection_limit(score, np.array([False, True, True, True, True]), 0.01) == 0.6
    assert language_id.rejection_limit(score, np.ones(5, bool), 0.01) == 0.0
    assert language_id.rejection_limit(score, np.zeros(5, bool), 0.01) == 0.999


def test_held_out_of_null(spark):
    assert spark.range(1).select(held_out(F.lit(None).cast("long")).alias("h")).first().h is False


CLASHING = ("id", "l", "n", "rank", "tag", "_of", "pos", "low", "key", "idx")


def clashing(df):
    return df.withColumns({c: F.lit(1) for c in CLASHING})


def test_columns_of_any_name(docs_of):
    train = clashing(docs_of([(i, "the cat and the dog " * 3, "en") for i in range(30)] + [(100 + i, "der hund und die katze " * 3, "de") for i in range(30)]))
    model = language_id.fit(train)
    kept = language_id.accept(train, model)
    assert kept.columns == train.columns and kept.count() == 60 and language_id.predict(train, model).count() == 60


def test_every_label_is_learned(docs_of):
    rows = [(10 * k + j, f"{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + k % 7)}o " * 12, f"l{k:03d}") for k in range(230) for j in range(2)]
    assert len(language_id.fit(docs_of(rows), params=language_id.Params(epochs=1)).langs) == 230


def test_the_sample_is_bounded_for_null_and_repeated_rows(docs_of, monkeypatch):
    seen = []
    monkeypatch.setattr(language_id, "train", lambda samples, p: seen.append(samples))
    copies = [(None, "one text many times", "en")] * 500 + [(7, "another text of one id", "en")] * 500
    rows = copies + [(None, f"text number {i} without id", "en") for i in range(600)] + [(5, f"text number {i} of one id", "en") for i in range(600)]
    language_id.fit(docs_of(rows), params=language_id.Params(per_lang=80))
    assert len(seen[0]) == 80
    language_id.fit(docs_of(copies), params=language_id.Params(per_lang=80))
    assert len(seen[1]) == 2  # equal rows count once
