"""Quality rules with compression bands.

Base rules fail texts of fewer than 20 words and texts of which more than 30 % of the
words lie in repeated 8-word windows. The method then compresses the whole text and each
fixed chunk of it with zstandard; the ratio (raw bytes / compressed bytes) must lie
inside a band that depends on the length: above it the text repeats itself, below it is
incompressible. Short texts are not compressed: a ratio of a few hundred bytes says
little. The rest after the last full chunk is judged by the band for its length; a rest too
short for a band by the last ``chunk`` bytes of the text. A text is kept if its own ratio is in
its band and at most ``max_bad_share`` of its bytes lie in chunks (the rest is one) outside
their band. A text shorter than a chunk is one rest: its own ratio judges it.

The bands are fixed parameters, equal at every input size; the operator is one pass of
independent rows without a shuffle. Null and empty texts: zero words, base_failed. Long
texts are compressed whole, chunk by chunk. Repeated rows are judged one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from pulsegrid.llm.common import map_batches, type_of
from pulsegrid.llm.text_stats import SYMBOLS, duplicate_lines, repeated_in_windows, word_chars, word_ids


@dataclass(frozen=True)
class Bands:
    #: (texts of at least so many bytes, smallest ratio, largest ratio); below the first: not judged.
    whole: tuple[tuple[int, float, float], ...] = ((256, 0.98, 3.2), (1_024, 1.15, 4.0), (4_096, 1.3, 5.0), (16_384, 1.4, 6.0), (65_536, 1.5, 7.0))
    chunk: int = 4_096
    chunk_low: float = 1.25
    chunk_high: float = 5.0
    max_bad_share: float = 0.25
    level: int = 3


def ratio(data: bytes, packer: zstandard.ZstdCompressor) -> float:
    """Raw bytes by compressed bytes; 0 for no data."""
    return len(data) / len(packer.compress(data)) if data else 0.0


def band_of(size: int, bands: Bands) -> tuple[float, float] | None:
    return next(((lo, hi) for least, lo, hi in reversed(bands.whole) if size >= least), None)


def judge(data: bytes, packer: zstandard.ZstdCompressor, bands: Bands) -> tuple[float, float, int, int, bool]:
    """(whole ratio, largest chunk ratio, chunks, chunks outside their band, inside the bands)."""
    whole = ratio(data, packer)
    band = band_of(len(data), bands)
    inside = band is None or band[0] <= whole <= band[1]
    full = len(data) - len(data) % bands.chunk
    if not full:
        return whole, 0.0, 0, 0, inside
    chunk_band = bands.chunk_low, bands.chunk_high
    parts = [(bands.chunk, ratio(data[i : i + bands.chunk], packer), chunk_band) for i in range(0, full, bands.chunk)]
    if rest := len(data) - full:
        own = band_of(rest, bands)
        parts.append((rest, ratio(data[full:] if own else data[-bands.chunk :], packer), own or chunk_band))
    bad = [size for size, x, (low, high) in parts if not low <= x <= high]
    return whole, max(x for _, x, _ in parts), len(parts), len(bad), inside and sum(bad) <= bands.max_bad_share * len(data)


SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "ratio double, max_chunk_ratio double, n_chunks long, n_bad_chunks long"
)


def rules(docs: DataFrame, bands: Bands = Bands(), min_words: int = 20, max_repeat_pct: int = 30) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with the base counts, the ratios and the verdict."""

    def run(batches):
        packer = zstandard.ZstdCompressor(level=bands.level)
        for b in batches:
            out: list[list] = [[] for _ in range(11)]
            for text in b.column("text").to_pylist():
                text = text or ""
                data = text.encode("utf-8", "surrogatepass")
                words = data.split()
                n, rep = len(words), repeated_in_windows(word_ids(words))
                failed = n < min_words or 100 * rep > max_repeat_pct * n
                whole, top, parts, bad, inside = judge(data, packer, bands)
                row = (n, word_chars(text), sum(map(text.count, SYMBOLS)), duplicate_lines(text), rep, failed, inside and not failed, whole, top, parts, bad)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2 + [pa.int64()] * 2
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(np.asarray(c), t) for c, t in zip(out, kinds))], names=["doc_id", *names])

    return map_batches(docs.select("doc_id", "text"), run, f"doc_id {type_of(docs, 'doc_id')}, {SCHEMA}")
