import numpy as np
from llm_fixtures import SF_SMALL, docs_of  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import packing


def rebuilt(rows, capacity):
    back = {}
    for r in rows:
        ids = packing.matrix(r.ids)
        assert len(ids) == capacity and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= capacity
        assert (ids[r.n_tokens :] == 50_256).all()
        place = packing.positions(r.position_resets, capacity)
        for doc, start, a, z in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            back.setdefault(doc, []).append((start, ids[a:z].tolist()))
            assert (place[a:z] == np.arange(z - a)).all()
    return {d: sum((p for _, p in sorted(parts)), []) for d, parts in back.items()}


def test_round_trip(spark, docs_of):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows += [(10_000, None), (10_001, ""), (10_002, " "), (10_003, "  two  blanks\n\n here "), (10_004, "long text of words " * 9000), (10_005, "<|endoftext|> x\x85y　z")]
    coder = packing.Encoder(packing.VOCAB)
    for capacity in (64, 2048):
        got = packing.packed(docs_of(rows).withColumn("ids", F.lit(1)), capacity=capacity, group_tokens=20_000).collect()
        back = rebuilt(got, capacity)
        for doc, text in rows:
            assert back.get(doc, []) == (coder.plain.encode_ordinary(text) if text else [])
        assert len({r.row_id for r in got}) == len(got)


def test_fast_path_gives_the_same_ids():
    coder = packing.Encoder(packing.VOCAB)
    for t in ["a b", "it's  'll x'll", " a", "a ", "\n", "a\nb\tc", "\x1c\x1d a", "a  b", "9" * 500 + " x" * 500, "日本 語"]:
        assert packing.matrix(coder.encode(t)).tolist() == coder.plain.encode_ordinary(t)


def best_fit(sizes, capacity):
    rows, room = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in range(len(rows)) if room[r] >= sizes[i]]
        row = min(fits, key=lambda r: room[r]) if fits else len(rows)
        if not fits:
            rows.append([])
            room.append(capacity)
        rows[row].append(i)
        room[row] -= sizes[i]
    return room


def test_best_fit_decreasing():
    rng = np.random.default_rng(0)
    for capacity in (1, 7, 64, 100):
        for n in (0, 1, 50, 400):
            sizes = rng.integers(1, capacity + 1, n).tolist()
            rows = packing.pack(sizes, capacity)
            assert sorted(i for r in rows for i in r) == list(range(n))
            assert sorted(capacity - sum(sizes[i] for i in r) for r in rows) == sorted(best_fit(sizes, capacity))


def test_edge_rows(spark, docs_of):
    assert packing.packed(docs_of([])).count() == 0
    got = packing.packed(docs_of([(None, "same words"), (None, "same words"), (1, "same words")]).coalesce(1)).collect()
    assert sorted((d or 0) for r in got for d in r.doc_ids) == [0, 0, 1]
