import hashlib
import random

import numpy as np
from llm_fixtures import SF_SMALL, docs_of, sf_of  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import minhash, queries


def plain(rows):
    """(id, text) -> {place: (id, n_chars, sha of the edited text, next text)} by a sorted list."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (d, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + nxt[:half]
        out.append((d, t, changed, nxt))
    return out


def word_sets(text):
    words = text.encode().split()
    if len(words) < minhash.WIDTH:
        line = b" ".join(words).decode()
        return {line[i : i + 5] for i in range(max(1, len(line) - 4))} if line else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def jaccard(a, b):
    x, y = word_sets(a), word_sets(b)
    return len(x & y) / len(x | y) if x | y else float(not x and not y)


EDGE = [(90_001, None), (90_002, ""), (90_003, " \n"), (90_004, "x"), (90_005, "漢字 é😀"), (90_006, "same " * 60_000), (90_007, "a b c d"), (90_008, "a b c d e")]


def test_rows_equal_a_sorted_list(spark, sf_of):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()] + EDGE
    random.Random(4).shuffle(rows)
    got = {r.doc_id: r for r in queries.op12_minhash(spark, sf_of(rows)).collect()}
    assert len(got) == len(rows)
    errors = []
    for d, t, changed, nxt in plain(rows):
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert r.fingerprint == minhash.signature(minhash.shingles(t)).tobytes().hex()
        assert r.edited_fingerprint == minhash.signature(minhash.shingles(changed)).tobytes().hex()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        errors += [r.near_edited - jaccard(t, changed), r.near_next - jaccard(t, nxt)]
    # standard error of 128 permutations is at most 0.045
    assert max(map(abs, errors)) < 0.2 and abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045


def test_null_and_shared_ids_and_one_row(docs_of):
    rows = [(None, "p q r s t u"), (None, "v w x y z"), (5, "a b"), (5, "a b"), (5, "c d"), (9, None)]
    docs = docs_of(rows).withColumn("tie", F.lit(1)).withColumn("place", F.lit("a")).withColumn("part", F.lit(0)).withColumn("edge", F.lit("first"))
    got = minhash.with_edits(docs).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 9), (0, 11), (5, 3), (5, 3), (5, 3), (9, 0)]
    one = minhash.with_edits(docs_of([(1, "abcd efgh")])).collect()
    assert [r.edited_sha256 for r in one] == [hashlib.sha256(b"abcd abcd").hexdigest()]
    assert minhash.with_edits(docs_of([(1, "x")]).where("false")).count() == 0


def test_hash_functions_are_near_uniform():
    r = np.random.default_rng(0)
    x, y = r.integers(0, 1 << 32, 600, dtype=np.uint64), r.integers(0, 1 << 32, 600, dtype=np.uint64)
    for share in (0.2, 0.5, 0.8):
        both = round(600 * 2 * share / (1 + share))
        z = np.concatenate((x[:both], y[both:]))
        assert abs(minhash.likeness(minhash.signature(x), minhash.signature(z)) - share) < 0.15
    assert (minhash.signature(np.empty(0, np.uint64)) == 255).all()


def classes_of(rows, least):
    texts = sorted({t if t and t.split() else "" for _, t in rows})
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            if a and b and jaccard(a, b) >= least:
                parent[find(a)] = find(b)
    ids = {}
    for d, t in rows:
        ids.setdefault(find(t if t and t.split() else ""), set()).add(d)
    return {frozenset(v) for v in ids.values()}


def near_rows(seed=7):
    """Chains of texts that drift apart, copies, and texts that share long passages without being alike."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    rows, n = [], 0
    for chain in range(12):
        words = [word() for _ in range(60)]
        for step in range(10):
            rows.append((n, " ".join(words)))
            n += 1
            words = words[:]
            for _ in range(step % 3 and 1):
                words[r.randrange(60)] = word()
    shared = " ".join(word() for _ in range(40))
    for _ in range(40):
        rows.append((n, shared + " " + " ".join(word() for _ in range(r.choice([1, 2, 8, 30])))))
        n += 1
    return rows + [(n, None), (n + 1, " "), (n + 2, "one two"), (n + 3, "one two"), (n + 4, rows[0][1])]


def test_classes_equal_all_pairs(docs_of):
    rows = near_rows()
    got = {}
    for r in minhash.near_duplicates(docs_of(rows).withColumn("id", F.lit(1)).withColumn("print", F.lit(2)).withColumn("bucket", F.lit(0))).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert all(k == min(v) for k, v in got.items())
    assert {frozenset(v) for v in got.values()} == classes_of(rows, 0.8)


def test_classes_with_null_and_repeated_ids_and_empty_table(docs_of):
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "g h i j k l"), (None, "m n o p q r"), (None, "m n o p q r")]
    assert sorted((r.doc_id or 0, r.class_id or 0) for r in minhash.near_duplicates(docs_of(rows)).collect()) == [(0, 0), (0, 0), (0, 3), (3, 3), (3, 3)]
    assert minhash.near_duplicates(docs_of(rows).where("false")).count() == 0
