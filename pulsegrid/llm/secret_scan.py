"""Secret scans: patterns, and character Markov models compared by log-likelihood ratio.

Three base kinds are regular expressions (leftmost, without overlaps, failing matches dropped). The
method adds spans of kind ``random``: runs of token characters, or what base spans leave of them, whose
character bigrams are likelier under a model of random strings than under one of ordinary
identifiers by more than ``limit`` in all and ``rate`` a pair (natural logarithm). Both models are first-order
chains over ``ALPHABET``, trained from labelled samples; a pair's chance backs off to its second character's.

Everything is DataFrame and SQL functions. Matches get their places from the lengths of what is
between them (``split`` by the same pattern), summed in blocks, so a text with very many
matches costs no square of their number. The model is a bounded literal (67 x 67 ratios).

Defined results: null and empty texts have no spans; places are code points, ends exclusive; rows are
scanned one by one. Without labelled samples both models are uniform and no span is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (kind, pattern, group whose length counts, least length). A minimum in the pattern where that drops the same matches.
BASE = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}", 0, 24),
)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: The shortest run that reaches the limits below at the least rate; the limits decide on longer ones.
MIN_RUN = 11
#: Base values from this length on are examples of random strings; shorter ones are often words.
LEARNED = 20
RUN = ("random", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}+" % MIN_RUN, 0, MIN_RUN)
IDENTIFIER = r"[A-Za-z0-9+/_=-]{3,}+"
#: Added to each character's count, and the weight of a character's own chance beside the counts of its pairs.
SMOOTH = 0.5
BACKOFF = 10.0
#: Matches whose places are summed in one go.
BLOCK = 256
#: Odds of one in ten thousand before looking at the characters.
LIMIT = math.log(10_000)
#: Least ratio a character pair on average, so a long run of pairs that neither model knows does not add up.
RATE = 1.0
SPAN = "array<struct<start:int,place:int,stop:int,kind:string,value:string>>"


#: What the base spans leave of each run, as spans of its kind.
PIECES = """flatten(transform(runs, r -> aggregate(
  concat(filter(base, b -> b.start < r.stop and r.start < b.stop), array(named_struct('start', r.stop, 'place', r.place, 'stop', r.stop, 'kind', r.kind, 'value', ''))),
  named_struct('at', r.start, 'out', cast(array() as %s)),
  (a, b) -> named_struct('at', greatest(a.at, b.stop), 'out', if(b.start > a.at, concat(a.out, array(named_struct('start', a.at, 'place', r.place, 'stop', b.start, 'kind', r.kind, 'value', substring(r.value, a.at - r.start + 1, b.start - a.at)))), a.out)),
  a -> a.out)))""" % SPAN


def _quoted(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


def found(kind: str, pattern: str, group: int, least: int, place: int, text: str = "text") -> Column:
    """Spans of one kind: start, place of the kind in the listing, stop, kind, value of the group."""
    p = _quoted(pattern)
    zipped = f"arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {group}))"
    step = "named_struct('at', b.at + length(x.`0`) + length(x.`1`), 'out', concat(b.out, array(named_struct('start', b.at + length(x.`0`), 'stop', b.at + length(x.`0`) + length(x.`1`), 'g', x.`2`))))"
    empty = "cast(array() as array<struct<start:int,stop:int,g:string>>)"
    blocks = f"transform(sequence(0, (size(z) - 1) div {BLOCK}), i -> aggregate(slice(z, i * {BLOCK} + 1, {BLOCK}), named_struct('at', 0, 'out', {empty}), (b, x) -> {step}))"
    joined = f"aggregate({blocks}, named_struct('at', 0, 'parts', cast(array() as array<{SPAN}>)), (a, y) -> named_struct('at', a.at + y.at, 'parts', concat(a.parts, array(transform(filter(y.out, o -> length(o.g) >= {least}), o -> named_struct('start', a.at + o.start, 'place', {place}, 'stop', a.at + o.stop, 'kind', '{kind}', 'value', o.g))))), a -> flatten(a.parts))"
    # the array of matches is bound once as z; what follows the last match has none
    whole = f"transform(array(filter({zipped}, x -> x.`1` is not null)), z -> {joined})[0]"
    return F.expr(f"case when {text} rlike {p} then {whole} else cast(array() as {SPAN}) end")


def pairs(samples: DataFrame) -> DataFrame:
    """``samples(token, secret)`` -> (secret, a, b, n): counts of character pairs."""
    chars = samples.where(F.length("token") > 1).select("secret", F.split("token", "").alias("c"))
    both = F.explode(F.expr("zip_with(slice(c, 1, size(c) - 1), slice(c, 2, size(c) - 1), (a, b) -> struct(a, b))")).alias("p")
    return chars.select("secret", both).groupBy("secret", F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n"))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios, random against ordinary, of each pair of ``ALPHABET``, row by row. The driver gets at most 2 x 67 x 67 counts.

    A doubled character never speaks for a random string: rule lines and runs of one character are unseen in either model.
    """
    k = len(ALPHABET)
    count = {s: [[0] * k for _ in range(k)] for s in (True, False)}
    known = F.lit(ALPHABET)
    for r in pairs(samples).where(F.instr(known, F.col("a")) > 0).where(F.instr(known, F.col("b")) > 0).collect():
        count[r.secret][ALPHABET.index(r.a)][ALPHABET.index(r.b)] += r.n

    def chances(rows: list[list[int]]) -> list[list[float]]:
        single = [sum(row[j] for row in rows) + SMOOTH for j in range(k)]
        total = sum(single)
        return [[(row[j] + BACKOFF * single[j] / total) / (sum(row) + BACKOFF) for j in range(k)] for row in rows]

    ratio = []
    for i, (secret, plain) in enumerate(zip(chances(count[True]), chances(count[False]))):
        row = [round(math.log(x) - math.log(y), 4) for x, y in zip(secret, plain)]
        row[i] = min(row[i], 0.0)
        ratio += row
    return ratio


def log_ratio(token: Column, ratio: list[float]) -> Column:
    """Log-likelihood ratio of a token: the sum over its character pairs."""
    table = F.expr(f"cast(split('{','.join(map(str, ratio))}', ',') as array<double>)")
    code = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pair = lambda a, b: F.element_at(table, (a - 1) * len(ALPHABET) + b)
    # the code before is carried along
    return F.aggregate(
        code,
        F.struct(F.lit(0).alias("a"), F.lit(0.0).alias("s")),
        lambda acc, b: F.struct(b.alias("a"), (acc["s"] + F.when(acc["a"] > 0, pair(acc["a"], b)).otherwise(0.0)).alias("s")),
        lambda acc: acc["s"],
    )


def labelled(docs: DataFrame, ordinary_rows: int = 2000) -> DataFrame:
    """Samples (token, secret) from ``docs(doc_id, text)``, of about ``ordinary_rows`` rows with the lowest hashes.

    Random strings are what the base patterns find in all rows, and a digest in base64 for each sampled row (so that strings
    of all characters are known however few secrets the rows hold). Identifiers outside of base matches are ordinary.
    """
    values = [F.when(F.col("text").rlike(p), F.regexp_extract_all("text", F.lit(p), F.lit(g))) for _, p, g, _ in BASE]
    secret = docs.select(F.explode(F.concat(*[F.coalesce(v, F.array().cast("array<string>")) for v in values])).alias("token")).where(F.length("token") >= LEARNED)
    rows = max(docs.count(), 1)
    rest = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) * F.lit(rows) <= F.lit(ordinary_rows * (1 << 30)))
    digest = rest.select(F.rtrim(F.base64(F.unhex(F.sha2(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), 256))), F.lit("=")).alias("token"))
    for _, p, _, _ in BASE:
        rest = rest.withColumn("text", F.regexp_replace("text", p, " "))
    plain = rest.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("token"))
    return secret.unionByName(digest).select("token", F.lit(True).alias("secret")).unionByName(plain.select("token", F.lit(False).alias("secret")))


def scan(docs: DataFrame, ratio: list[float], limit: float = LIMIT, rate: float = RATE) -> DataFrame:
    """``docs(doc_id, text)`` -> (doc_id, base, added): arrays of spans (start, place, stop, kind, value), sorted."""
    text = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    based = text.select("doc_id", F.array_sort(F.concat(*[found(*k, place=i) for i, k in enumerate(BASE)])).alias("base"), found(*RUN, place=len(BASE)).alias("runs"))
    return based.select("doc_id", "base", F.expr(f"filter({PIECES}, p -> p.stop - p.start >= {MIN_RUN})").alias("runs")).select("doc_id", "base", F.filter("runs", lambda r: log_ratio(r["value"], ratio) > F.greatest(F.lit(limit), rate * (F.length(r["value"]) - 1))).alias("added"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
