"""Quality classifier from weak labels.

1. Heuristic labellers vote good, bad or nothing on every document, from counts
   over its whole text.
2. Expectation-maximisation over the table of vote patterns (at most
   3 ** labellers rows, counted by Spark over all documents) estimates how
   often each labeller is right about good and about bad documents, and the
   share of good ones; from these every pattern gets a posterior.  No gold
   label is read.
3. The posteriors of about ``train_rows`` distinct texts at most (those with the
   smallest hashes: a documented bound, the same texts each time) train a logistic scorer
   on hashed features: byte trigrams, character-shape 4-grams and word repeats.
4. The scorer judges every whole text; below ``threshold`` a document goes.

Defined cases: null text and text without words score 0 and are rejected; an
empty table trains nothing; repeated rows count as often as they occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from .common import append_columns, fresh
from .texts import LOWER, SPACE, chunks, runs, segment_sum, word_hashes

#: Labellers, in the order of their votes.  Fixed thresholds.
LABELLERS = ("symbols", "capitals", "repeats", "variety", "wordless", "sentences", "letters")
#: Expected number of training documents.
TRAIN_ROWS = 4000
#: Bytes added to a text's length: short texts stay near the scorer's bias.
SHRINK = 200
#: Hashed dimensions: byte trigrams, shape 4-grams, and the repeat shares.
RAW_BITS, SHAPE_BITS, EXTRA = 13, 12, 2
DIMENSIONS = (1 << RAW_BITS) + (1 << SHAPE_BITS) + EXTRA


def _classes(members: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members.encode())] = True
    return out


UPPER = _classes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = UPPER | _classes("abcdefghijklmnopqrstuvwxyz")
LETTER[128:] = True
SYMBOL = _classes("#*$%&|<>!~^=_{}[]\\@+")
ENDING = _classes(".!?")
#: Shape of a byte: its class for letters and digits, else the byte itself.
SHAPE = np.arange(256, dtype=np.uint8)
SHAPE[LETTER] = ord("a")
SHAPE[UPPER] = ord("A")
SHAPE[128:] = ord("a")
SHAPE[48:58] = ord("0")


def _share(part, whole):
    return part / np.maximum(whole, 1)


def _band(value, bad, good, low_is_good=True):
    """+1 on the good side, -1 on the bad side, 0 between."""
    if low_is_good:
        return (value <= good).astype(np.int8) - (value >= bad).astype(np.int8)
    return (value >= good).astype(np.int8) - (value <= bad).astype(np.int8)


def _words(data, offs):
    starts, ends, first = runs(~SPACE[data], offs)
    return starts, ends, first, word_hashes(data, starts, ends)


def _repeats(hashes, first):
    """For each row: words equal to the one before, and to one of the three
    before that."""
    near, far = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
    for back in (1, 2, 3, 4):
        same = np.zeros(len(hashes), bool)
        same[back:] = hashes[back:] == hashes[:-back]
        for k in range(back):  # the first words of a row have none before them
            at = first[:-1] + k
            same[at[at < first[1:]]] = False
        if back == 1:
            near += same
        else:
            far |= same
    return segment_sum(near, first), segment_sum(far, first)


def votes_of(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(rows, labellers) votes in -1, 0, 1."""
    starts, ends, first, hashes = _words(data, offs)
    n = np.diff(first)
    count = lambda mask: segment_sum(mask.astype(np.int64), offs)
    letters, upper, symbols, dark = count(LETTER[data]), count(UPPER[data]), count(SYMBOL[data]), count(~SPACE[data])
    row = np.repeat(np.arange(len(n)), n)
    keys = np.sort((row.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    new = np.ones(len(keys), np.int64)
    new[1:] = keys[1:] != keys[:-1]
    distinct = segment_sum(new, first)
    has_letter = np.concatenate([[0], np.cumsum(LETTER[data].astype(np.int64))])
    wordless = segment_sum((has_letter[ends] == has_letter[starts]).astype(np.int64), first)
    ending = segment_sum(ENDING[data[ends - 1]].astype(np.int64) if len(ends) else np.zeros(0, np.int64), first)
    near, _ = _repeats(hashes, first)
    ends_share = _share(ending, n)
    out = np.stack([
        np.where(n >= 10, _band(_share(symbols, n), 0.3, 0.05), 0),
        np.where(n >= 10, _band(_share(upper, letters), 0.4, 0.15), 0),
        np.where(n >= 10, _band(_share(near, n), 0.15, 0.03), 0),
        np.where(n >= 30, _band(distinct / np.sqrt(np.maximum(n, 1)), 2.0, 4.0, False), 0),
        np.where(n >= 10, _band(_share(wordless, n), 0.1, 0.02), 0),
        np.where(n >= 20, np.where((ends_share >= 0.02) & (ends_share <= 0.35), 1, np.where((ends_share <= 0.005) | (ends_share >= 0.6), -1, 0)), 0),
        np.where(n >= 10, _band(_share(letters, dark), 0.7, 0.88, False), 0),
    ], axis=1).astype(np.int8)
    out[n == 0] = -1
    return out


def vote_codes(texts: DataFrame, text: str) -> DataFrame:
    """``texts`` with a column ``votes``: the pattern as a base-3 number."""
    def compute(column):
        out = [np.zeros(0, np.int32)]
        for _, _, data, offs in chunks(column):
            v = votes_of(data, offs)
            out.append(((v + 1) * 3 ** np.arange(v.shape[1])).sum(axis=1).astype(np.int32))
        return [pa.array(np.concatenate(out), pa.int32())]

    return append_columns(texts, text, [StructField("votes", IntegerType())], compute)


def decode(codes: np.ndarray) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(len(LABELLERS))) % 3 - 1


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation: (posterior that each pattern is good, accuracy
    of each labeller on (bad, good) documents when it votes, share of good).
    Votes are taken as independent given the class; a silent labeller says
    nothing.  It starts from the number of bad votes, since the labellers look
    for different faults; a weak prior (8 right, 2 wrong) keeps the classes from
    swapping."""
    counts = counts.astype(float)
    bad_votes = (patterns < 0).sum(axis=1)
    good = np.choose(np.minimum(bad_votes, 2), [0.95, 0.2, 0.02])
    accuracy, share = np.full((len(LABELLERS), 2), 0.8), 0.5
    for _ in range(rounds):
        for y, w in ((1, good * counts), (0, (1 - good) * counts)):
            right = ((patterns == 2 * y - 1) * w[:, None]).sum(axis=0)
            voted = ((patterns != 0) * w[:, None]).sum(axis=0)
            accuracy[:, y] = (right + 8) / (voted + 10)
        share = ((good * counts).sum() + 1) / (counts.sum() + 2)
        logit = np.full(len(patterns), np.log(share / (1 - share)))
        logit = logit + np.where(patterns > 0, np.log(accuracy[:, 1] / (1 - accuracy[:, 0])), 0).sum(axis=1)
        logit = logit + np.where(patterns < 0, np.log((1 - accuracy[:, 1]) / accuracy[:, 0]), 0).sum(axis=1)
        good = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
    return good, accuracy, share


def _grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashed trigram and shape 4-gram at each byte; spaces follow a row's
    last byte, whatever row comes next."""
    def ahead(values, k):
        out = np.concatenate([values[k:], np.full(min(k, len(values)), 32, np.uint8)])
        for j in range(1, k + 1):
            at = offs[1:] - j
            out[at[at >= offs[:-1]]] = 32
        return out.astype(np.uint32) << np.uint32(8 * k)

    low, shape = LOWER[data], SHAPE[data]
    raw = ahead(low, 0) | ahead(low, 1) | ahead(low, 2)
    four = ahead(shape, 0) | ahead(shape, 1) | ahead(shape, 2) | ahead(shape, 3)
    with np.errstate(over="ignore"):
        return (raw * np.uint32(2654435761)) >> np.uint32(32 - RAW_BITS), ((four * np.uint32(2246822519)) >> np.uint32(32 - SHAPE_BITS)) + np.uint32(1 << RAW_BITS)


def _extra(data, offs):
    """Shares of repeated words, one column each."""
    _, _, first, hashes = _words(data, offs)
    near, far = _repeats(hashes, first)
    n = np.diff(first)
    return np.stack([_share(near, n), _share(far, n)], axis=1), n


def training_rows(sample: DataFrame) -> DataFrame:
    """(key, votes, dims, values) of (key, text, votes): sparse features."""
    def rows(batches):
        for batch in batches:
            for i, j, data, offs in chunks(batch.column("text")):
                raw, shape = _grams(data, offs)
                extra, _ = _extra(data, offs)
                dims, values = [], []
                for k in range(j - i):
                    a, b = offs[k], offs[k + 1]
                    at, n = np.unique(np.concatenate([raw[a:b], shape[a:b]]), return_counts=True)
                    dims.append(np.concatenate([at.astype(np.int32), np.arange(DIMENSIONS - EXTRA, DIMENSIONS, dtype=np.int32)]))
                    values.append(np.concatenate([n / (b - a + SHRINK), extra[k]]).astype(np.float32))
                yield pa.RecordBatch.from_arrays([batch.column("key").slice(i, j - i), batch.column("votes").slice(i, j - i), pa.array(dims, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], names=["key", "votes", "dims", "values"])

    return sample.mapInArrow(rows, "key long, votes int, dims array<int>, values array<float>")


def fit(dims: list[np.ndarray], values: list[np.ndarray], good: np.ndarray, steps: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic scorer on soft labels (Adam, L2)."""
    w, bias = np.zeros(DIMENSIONS), 0.0
    if not len(good):
        return w, bias
    lengths = np.array([len(d) for d in dims])
    row, col, val = np.repeat(np.arange(len(dims)), lengths), np.concatenate(dims), np.concatenate(values).astype(float)
    scale = np.sqrt(np.bincount(col, val * val, DIMENSIONS) / len(dims)) + 1e-4
    val = val / scale[col]
    m, v, rate = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1), 0.03
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, val * w[col], len(dims)) + bias, -30, 30)))
        off = (p - good) / len(dims)
        g = np.append(np.bincount(col, val * off[row], DIMENSIONS) + 1e-3 * w, off.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return w / scale, float(bias)


def train(docs: DataFrame, text: str = "text", train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float, dict]:
    """(weights, bias, report with the labellers' accuracies)."""
    texts = docs.select(F.col(text).alias("text"))
    voted = vote_codes(texts, "text")
    found = voted.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").toArrow()
    codes, counts = found.column("votes").to_numpy(), found.column("n").to_numpy()
    good, accuracy, share = estimate(decode(codes), counts)
    total = int(counts.sum())
    # the texts with the smallest hashes: a binomial number about train_rows;
    # copies of one text share a hash and count once, however many they are
    keyed = texts.where(F.col("text").isNotNull()).select(F.shiftrightunsigned(F.xxhash64("text"), 2).alias("key"), "text")
    distinct = keyed.agg(F.count_distinct("key")).first()[0]
    limit = int(min(1.0, train_rows / max(distinct, 1)) * float(1 << 62))
    picked = keyed.where(F.col("key") < limit).dropDuplicates(["key"])
    sample = vote_codes(picked, "text")
    rows = training_rows(sample).toArrow().sort_by([("key", "ascending")])
    labels = dict(zip(codes.tolist(), good.tolist()))
    w, bias = fit([x.values.to_numpy() for x in rows.column("dims")], [x.values.to_numpy() for x in rows.column("values")], np.array([labels[x] for x in rows.column("votes").to_pylist()]))
    return w, bias, {"accuracy": dict(zip(LABELLERS, accuracy.tolist())), "good": share, "patterns": len(codes), "rows": total, "distinct": distinct, "trained_on": rows.num_rows}


def with_scores(docs: DataFrame, w: np.ndarray, bias: float, name: str, text: str = "text") -> DataFrame:
    """``docs`` with the probability ``name`` that each document is good."""
    w = w.astype(np.float32)

    def compute(column):
        out = [np.zeros(0)]
        for _, _, data, offs in chunks(column):
            raw, shape = _grams(data, offs)
            extra, n = _extra(data, offs)
            sums = segment_sum((w[raw] + w[shape]).astype(float), offs)
            logit = sums / (np.diff(offs) + SHRINK) + extra @ w[-EXTRA:] + bias
            out.append(np.where(n > 0, 1 / (1 + np.exp(-np.clip(logit, -30, 30))), 0.0))
        return [pa.array(np.concatenate(out), pa.float64())]

    return append_columns(docs, text, [StructField(name, DoubleType())], compute)


def classify(docs: DataFrame, threshold: float = 0.5, key: str = "doc_id", text: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """key, score and kept of every document."""
    w, bias, _ = train(docs, text, train_rows)
    return with_scores(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), w, bias, "score").select(
        F.col("key").alias(key), F.round("score", 6).alias("score"), (F.col("score") >= threshold).alias("kept"))


def good_documents(docs: DataFrame, threshold: float = 0.5, text: str = "text", train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    w, bias, _ = train(docs, text, train_rows)
    name = fresh(docs, "score")[0]
    return with_scores(docs, w, bias, name, text).where(F.col(name) >= threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
