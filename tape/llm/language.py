"""Language identification by inference of each document's language mixture.

Model: for every language of the training rows, smoothed counts of hashed byte
trigrams inside words (one per letter byte: the bytes before, at and after it,
word edges as a space).

Inference: each word of a document has a likelihood under each language, the
product of its trigrams (to the power 1/3, as each byte is in three of them).
Expectation-maximisation over the words gives the document's language
proportions.  Which languages are in the document is decided by penalised
likelihood: languages enter in the order of their proportions, and the set of k
with the largest log-likelihood minus (k - 1) * log(words) * ``penalty`` stays.
The prediction is the language of the largest proportion, the score that
proportion.

Defined cases: null text and text without a letter are ``und`` with score 0;
a text whose every word is equally likely in all languages takes the first
language in code point order of equal proportions; rows without id or language
are not trained on; without any training row every text is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from .common import append_columns
from .texts import LOWER, chunks, runs, segment_sum

#: Hashed trigram dimensions of the model, and the additive smoothing.
BITS, SMOOTHING = 16, 0.5
#: Rounds of expectation-maximisation, and the cost of a further language.
ROUNDS, PENALTY = 12, 1.0
#: Letters by byte: ASCII letters and every byte of other characters.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
UNKNOWN = "und"


def trigrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed trigram of every letter byte, first trigram of each word with
    their number at the end, first word of each row with their number)."""
    letter = LETTER[data]
    starts, ends, first = runs(letter, offs)
    low = np.where(letter, LOWER[data], 32).astype(np.uint32)
    before, after = np.full(len(data), 32, np.uint32), np.full(len(data), 32, np.uint32)
    before[1:], after[:-1] = low[:-1], low[1:]
    before[starts], after[ends - 1] = 32, 32
    gram = before << np.uint32(16) | low << np.uint32(8) | after
    with np.errstate(over="ignore"):
        gram = (gram * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    bounds = np.concatenate([[0], np.cumsum(ends - starts)])
    return gram[letter], bounds, first


def is_held_out(key: Column) -> Column:
    """Rows that take no part in training: crc32 of the id as text, mod 4, is
    2.  A null id is neither held out nor trained on."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities by dimension and language) from all of
    ``rows`` (lang, text)."""
    def count(batches):
        totals: dict[str, np.ndarray] = {}

        def flush():
            for lang, total in totals.items():
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["lang", "dim", "n"])
            totals.clear()

        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for i, j, data, offs in chunks(batch.column("text")):
                grams, bounds, first = trigrams(data, offs)
                edges = bounds[first]
                for lang in set(langs[i:j]):
                    mine = [grams[edges[k]:edges[k + 1]] for k in range(j - i) if langs[i + k] == lang]
                    totals.setdefault(lang, np.zeros(1 << BITS, np.int64))
                    totals[lang] += np.bincount(np.concatenate(mine), minlength=1 << BITS)
            if len(totals) > 64:
                yield from flush()
        yield from flush()

    found = rows.mapInArrow(count, "lang string, dim int, n long").groupBy("lang", "dim").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    at = {lang: k for k, lang in enumerate(langs)}
    counts = np.full((1 << BITS, len(langs)), SMOOTHING)
    if langs:
        counts[found.column("dim").to_numpy(), [at[x] for x in found.column("lang").to_pylist()]] += found.column("n").to_numpy()
    return langs, np.log(counts / counts.sum(axis=0)) if langs else counts


def _mixture(like: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (rows, languages) and log-likelihoods (rows) by
    expectation-maximisation; ``allowed`` marks each row's language set."""
    n = np.diff(first)
    row = np.repeat(np.arange(len(n)), n)
    share = allowed / np.maximum(allowed.sum(axis=1, keepdims=True), 1)
    for _ in range(rounds):
        part = like * share[row]
        part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
        share = segment_sum(part, first) / np.maximum(n, 1)[:, None]
    total = segment_sum(np.log(np.maximum((like * share[row]).sum(axis=1), 1e-300)), first)
    return share, total


def infer(words: np.ndarray, first: np.ndarray, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """Proportions (rows, languages) of the selected language sets; ``words``
    are log-likelihoods (words, languages)."""
    n, count = np.diff(first), words.shape[1]
    like = np.exp(words - words.max(axis=1, keepdims=True)) if len(words) else words
    everything = np.ones((len(n), count), bool)
    full, full_total = _mixture(like, first, everything, rounds)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    cost = penalty * np.log(np.maximum(n, 2))
    best, best_value = np.zeros_like(full), np.full(len(n), -np.inf)
    for k in range(1, count + 1):
        # no set of more languages can reach more than the full one does
        open_ = np.flatnonzero((full_total - (k - 1) * cost > best_value) | (k == 1))
        if not len(open_):
            continue
        if k == 1:
            allowed = rank[open_] < 1
            row = np.repeat(np.arange(len(n)), n)
            lead = np.argmax(allowed, axis=1)
            share, total = allowed.astype(float), segment_sum(np.log(np.maximum(like[np.arange(len(like)), lead[row]], 1e-300)), first)
        else:
            picked = np.concatenate([np.arange(first[r], first[r + 1]) for r in open_])
            bounds = np.concatenate([[0], np.cumsum(n[open_])])
            share, total = _mixture(like[picked], bounds, rank[open_] < k, rounds)
        value = total - (k - 1) * cost[open_]
        better = value > best_value[open_]
        best[open_[better]], best_value[open_[better]] = share[better], value[better]
    return best


def with_language(docs: DataFrame, langs: list[str], logs: np.ndarray, names: list[str], text: str = "text", penalty: float = PENALTY) -> DataFrame:
    """``docs`` with the predicted language and its proportion (``names``).
    The text must be null where it has no letter."""
    logs = logs.astype(np.float32)

    def compute(column):
        preds, scores = [], []
        for _, _, data, offs in chunks(column):
            grams, bounds, first = trigrams(data, offs)
            row_words = np.diff(first)
            if langs and len(grams):
                words = np.add.reduceat(logs[grams], bounds[:-1], axis=0).astype(float) / 3
                share = infer(words, first, penalty)
                lead = share.argmax(axis=1)
            else:
                share, lead = np.zeros((len(row_words), max(1, len(langs)))), np.zeros(len(row_words), int)
            for k, n in enumerate(row_words):
                known = bool(n) and bool(langs)
                preds.append(langs[lead[k]] if known else UNKNOWN)
                scores.append(float(min(1.0, share[k, lead[k]])) if known else 0.0)
        return [pa.array(preds, pa.string()), pa.array(scores, pa.float64())]

    return append_columns(docs, text, [StructField(names[0], StringType()), StructField(names[1], DoubleType())], compute)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", penalty: float = PENALTY) -> DataFrame:
    """key, held_out, lang_pred, score of every document; learns from the rows
    that are not held out."""
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where(
        docs[key].isNotNull() & ~is_held_out(docs[key]) & docs[lang].isNotNull() & docs[text].isNotNull())
    langs, logs = learn(rows)
    lettered = F.when(F.col(text).rlike(r"\p{L}"), F.col(text))
    judged = with_language(docs.select(F.col(key).alias("key"), lettered.alias("text")), langs, logs, ["lang_pred", "score"], "text", penalty)
    return judged.select(F.col("key").alias(key), is_held_out(F.col("key")).alias("held_out"), "lang_pred", F.round("score", 6).alias("score"))
