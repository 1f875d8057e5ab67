"""Quality rules from zstandard compression bands.

Every whole text and every fixed chunk of it is compressed.  A text whose ratio
(compressed / raw bytes) lies outside the limits for its length is rejected: too
low is repetitive, too high is incompressible (noise, encoded data).  So is one
with too large a share of chunks outside the chunk limits.

Counts for plain rules go with it: characters in words, symbols, repeated
lines, and words in 5-word windows that occur twice or more.

Defined cases: null text has no words and fails the base rules, as does any
text of fewer than 10 words; texts of up to 64 bytes have no ratio limits, those
of up to 256 bytes no upper one (a frame's own bytes bring plain short text to
the ratios of noise); texts of at least one chunk (2,048 bytes) have their
chunks judged, and the last chunk is the text's last 2,048 bytes, which may
overlap the one before; shorter texts are judged by their whole ratio alone.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField

from .common import append_columns
from .texts import SPACE, chunks, runs, segment_sum, shingle_hashes, word_hashes

#: zstandard level.
LEVEL = 3
#: Limits by length: (bytes up to, lowest ratio, highest ratio).  Frame bytes
#: and an unfilled dictionary raise the ratio of short texts.
BANDS = ((64, 0.0, 9.0), (128, 0.45, 9.0), (256, 0.36, 9.0), (512, 0.32, 0.95), (1024, 0.29, 0.85),
         (2048, 0.26, 0.80), (4096, 0.23, 0.76), (16384, 0.20, 0.73), (float("inf"), 0.17, 0.72))
#: Chunk bytes, their limits, and the largest share of chunks outside them.
CHUNK, CHUNK_BAND, CHUNK_SHARE = 2048, (0.24, 0.80), 0.3
#: Base rules.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def repeated_words(windows: np.ndarray, n_words: int) -> int:
    """Words inside windows that occur twice or more."""
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    covered = np.zeros(n_words, bool)
    for k in range(WINDOW):
        covered[at + k] = True
    return int(covered.sum())


def repeated_lines(raw: bytes) -> int:
    seen, n = set(), 0
    for line in raw.split(b"\n"):
        if line.strip(b" \t\x0b\x0c\r"):
            n += line in seen
            seen.add(line)
    return n


def within_bands(raw: bytes, compress) -> tuple[bool, float, float]:
    """(verdict, ratio of the whole, share of chunks outside their limits)."""
    if not raw:
        return True, 0.0, 0.0
    ratio = len(compress(raw)) / len(raw)
    _, low, high = BANDS[bisect.bisect_left([b[0] for b in BANDS], len(raw))]
    outside = 0.0
    if len(raw) >= CHUNK:
        # all of one size, to which the limits apply: the last one ends with the text
        parts = [raw[k:k + CHUNK] for k in (*range(0, len(raw) - CHUNK, CHUNK), len(raw) - CHUNK)]
        ratios = [len(compress(p)) / len(p) for p in parts]
        outside = sum(not CHUNK_BAND[0] <= r <= CHUNK_BAND[1] for r in ratios) / len(ratios)
    return low <= ratio <= high and outside <= CHUNK_SHARE, ratio, outside


#: Columns that ``measure`` adds.
FIELDS = [StructField(c, LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")] + [
    StructField("in_band", BooleanType()), StructField("ratio", DoubleType()), StructField("outside", DoubleType())]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts, the verdict of the bands, and its ratios."""
    def compute(column):
        out = [[] for _ in FIELDS]
        compress = zstandard.ZstdCompressor(level=LEVEL).compress
        for i, j, data, offs in chunks(column):
            dark = ~SPACE[data]
            starts, ends, first = runs(dark, offs)
            windows, bounds = shingle_hashes(word_hashes(data, starts, ends), first, WINDOW)
            n = np.diff(first)
            raw = data.tobytes()
            out[0] += n.tolist()
            out[1] += segment_sum((dark & ((data & 0xC0) != 0x80)).astype(np.int64), offs).tolist()
            out[2] += segment_sum(SYMBOL[data].astype(np.int64), offs).tolist()
            for k in range(j - i):
                own = raw[offs[k]:offs[k + 1]]
                out[3].append(repeated_lines(own))
                out[4].append(repeated_words(windows[bounds[k]:bounds[k + 1]], int(n[k])) if n[k] > WINDOW else 0)
                for o, v in zip(out[5:], within_bands(own, compress)):
                    o.append(v)
        return [pa.array(o, pa.int64()) for o in out[:5]] + [pa.array(out[5], pa.bool_()), pa.array(out[6], pa.float64()), pa.array(out[7], pa.float64())]

    return append_columns(docs, text, FIELDS, compute)


def quality_rules(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the counts, base_failed and kept of every document."""
    measured = measure(docs.select(F.col(key).alias("key"), F.col(text).alias("text")))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return measured.select(
        F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("in_band")).alias("kept"), F.round("ratio", 6).alias("ratio"), F.round("outside", 6).alias("chunks_outside"))
