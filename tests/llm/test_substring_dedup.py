import hashlib
import random
import re

from llm_fixtures import docs_of, sf_of  # noqa: F401
from pyspark.sql import functions as F

from pulsegrid.llm import queries
from pulsegrid.llm import substring_dedup as sub


def brute(rows, window):
    """{doc: (words, removed, kept)}; rows in any order, ids unique"""
    cut = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    seen, gone = set(), {d: set() for d in cut}
    for d in sorted(cut):
        for i in range(len(cut[d]) - window + 1):
            key = tuple(cut[d][i : i + window])
            if key in seen:
                gone[d] |= set(range(i, i + window))
            seen.add(key)
    return {d: (len(w), len(gone[d]), " ".join(x for i, x in enumerate(w) if i not in gone[d])) for d, w in cut.items()}


def corpus(seed, n=120):
    rng = random.Random(seed)
    vocab = ["the", "of", "a"] * 4 + [f"w{i}" for i in range(60)]
    text = lambda k: [rng.choice(vocab) for _ in range(k)]
    shared = [text(rng.randint(15, 90)) for _ in range(6)]
    whole = text(200)
    rows = []
    for i in range(n):
        body = text(rng.randint(0, 120))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(body))
            body[at:at] = rng.choice(shared)
        if i % 5 == 0:
            body = list(whole)
            if i % 10:
                body[rng.randrange(200)] = "edit"
        rows.append((i * 7 % 1000, " ".join(body)))
    rows += [(2001, "same " * 300), (2002, "b c " * 100), (2003, None), (2004, ""), (2005, "tab\tand\x0bform\x0cfeed\r\n" * 30), (2006, "x " * 19), (2007, "é\x85ü " * 30)]
    return rows


def test_equals_brute_force(spark, sf_of):
    rows = corpus(1)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op9_substring_dedup(spark, sf_of(rows)).collect()}
    assert got == {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, (n, k, t) in brute(rows, 20).items()}
    assert sum(v[1] for v in got.values()) > 1000


def test_small_groups_lengthen_prefixes_and_salt(spark, docs_of):
    rows = corpus(2, 80)
    # many different surroundings of one passage: more equal suffixes than a group may have
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(25))
    rows += [(3000 + i, " ".join([f"u{rng.random()}"] * 3) + f" {i} " + passage + f" {i} end{i}") for i in range(60)]
    for group in (3, 10, 10_000):
        got = {r.doc_id: (r.n_words, r.n_removed, bytes(r.kept).decode()) for r in sub.remove(docs_of(rows).withColumn("doc", F.lit(1)).withColumn("ranges", F.lit(2)), 20, group).collect()}
        assert got == brute(rows, 20), group


def test_repeated_rows_and_null_ids(docs_of):
    text = " ".join(f"k{i}" for i in range(30))
    got = sorted((r.doc_id or 0, r.n_removed) for r in sub.remove(docs_of([(1, text), (1, text), (None, text), (2, text + " tail")])).collect())
    assert got == [(0, 30), (1, 0), (1, 0), (2, 30)]
    assert sub.remove(docs_of([])).count() == 0


def test_null_and_shared_ids_with_different_texts(docs_of):
    part = lambda name, k=30: " ".join(f"{name}{i}" for i in range(k))
    # of rows that share an id only the rows with a passage of document 1 lose it
    rows = [(1, part("one"))] + [(d, t) for d in (5, None) for t in (part("one") + " " + part(f"a{d}"), part(f"b{d}", 60), part(f"c{d}", 60)) for _ in range(2)]
    for group in (3, 10_000):
        got = sorted((r.doc_id or 0, bytes(r.kept).decode(), r.n_removed) for r in sub.remove(docs_of(rows), 20, group).collect())
        want = [(1, part("one"), 0)] + [(d or 0, t, n) for d in (5, None) for t, n in ((part(f"a{d}"), 30), (part(f"b{d}", 60), 0), (part(f"c{d}", 60), 0)) for _ in range(2)]
        assert got == sorted(want), group
    # a passage of two texts of one id stays in one of them, whatever surrounds it
    for d in (5, None):
        rows = [(d, part("x") + " " + part("p", 25) + " " + part("y")), (d, part("u") + " " + part("p", 25) + " " + part("v")), (d, part("p", 25))]
        got = [sorted((r.n_words, r.n_removed, bytes(r.kept)) for r in sub.remove(docs_of(x)).collect()) for x in (rows, rows[::-1])]
        assert got[0] == got[1] and sorted(n for _, n, _ in got[0]) == [0, 25, 25]


def test_long_text_in_blocks(monkeypatch):
    words = [w.encode() for w in ("a b c d e f g h i j k l m n o p q r s t u v " * 400).split()]
    whole = sub.anchors(words, 20)
    monkeypatch.setattr(sub, "BLOCK", 100)
    cut = sub.anchors(words, 20)
    cover = lambda x: {w: h for h, a, z in zip(*(v.tolist() for v in x)) for w in range(a, z + 1)}
    assert cover(whole) == cover(cut)


def test_deep_nodes():
    s = sorted([[b"a", b"b", b"c"], [b"a", b"b", b"c"], [b"a", b"b", b"d"], [b"x"], [b"x"]])
    assert sorted(sub.deep_nodes(s, 2)) == [(2, 0, 2), (3, 0, 1)]
    assert sub.deep_nodes(s, 1) and sub.deep_nodes([], 1) == []
