"""Collocations from n-gram counts of an FM-index per shard.

Texts are lower-cased (A-Z), split into pieces and words, and written as word
ids with a separator (id 0) between pieces.  A *shard* is what one task has read
of one language, up to ``SHARD_WORDS`` words.  Its index has two Burrows-Wheeler
transforms, of the ids read forwards and backwards, whose rows are sorted by
``DEPTH`` ids: enough for the intervals of all phrases up to that length.

A phrase is a pair of intervals, one in each direction.  Extending it by a word
on the right reads the backward transform inside its interval: each distinct
symbol is a right extension, the number of its rows is the longer phrase's
count, and C[symbol] plus its rank gives the new interval there (where it is
needed); the symbols below it give the new interval in the other direction.  The left is the mirror
image.  All intervals of a level are extended at once (numpy).

Two passes over the texts, each summed over the shards by Spark:

1. every word, and each word's right extensions: counts of words and word pairs;
2. left extensions of the pairs with ``least`` occurrences or more whose left
   pair has as many: counts of triples.  A bitmap of a fixed size (``BITS``)
   tells frequent pairs; it lets some more pass, never fewer, and what it lets
   pass is summed and cut exactly.

A phrase cannot be more frequent than its parts, so no candidate is lost.  A
shard that ends within a piece hands its last two words on to the next; what
that counts twice is taken off again, so cuts never show in the sums.

Numbers: counts are longs, a*a and l*r decimals of 38 digits (exact for
counts up to 10**16); scores at most 1,000,000.

Defined cases: null text is empty; a null language is ``und`` and one with
that name; ids and further columns are not used, whatever their names; equal rows
count as often as they come; a very long text fills as many shards as it needs
(a single word is held whole); an empty table gives no rows; ties in rank end at
the phrase's bytes.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, staged

#: Longest phrase.
DEPTH = 3
#: Words of a shard; ids need ID_BITS bits, so that three fit a signed 64-bit key.
SHARD_WORDS = 1 << 20
ID_BITS = 21
#: Texts that are sent to Python at once.
ROWS_AT_ONCE = 1000
#: Bytes of text that are split at once.
SLICE_BYTES = 1 << 20
#: Bits of the bitmap of frequent pairs: 16 MB, whatever their number.
BITS = 27
#: Seed of Spark's xxhash64 (a fixed value).
SPARK_SEED = 42

#: Bytes as they are read: A-Z lower-cased, ends of pieces a full stop, tab a blank.
READ = bytearray(range(256))
READ[65:91] = range(97, 123)
for _c in b",;:!?\n\x0b\x0c\r":
    READ[_c] = ord(".")
READ[9] = 32
READ = bytes(READ)


def tokens_of(text: bytes, most: int):
    """Words and full stops of a text, in lists of about ``most`` bytes, the end
    of the text being a full stop too."""
    at = 0
    while len(text) - at > most:
        end = at + most
        cuts = [k for k in (text.rfind(b" ", at, end), text.rfind(b".", at, end)) if k > at]
        if not cuts:
            cuts = [min((k for k in (text.find(b" ", end), text.find(b".", end)) if k >= 0), default=len(text))]
        yield text[at:max(cuts)].replace(b".", b" . ").split()
        at = max(cuts)
    yield (text[at:] + b".").replace(b".", b" . ").split()


class Ids(dict):
    """A word's number, given at first sight."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n


class Shard:
    """Word ids of one language as they are read."""

    def __init__(self, carried: list[bytes] = ()):
        self.ids, self.parts, self.size = Ids({b".": 0}), [], 0
        self.carried = list(carried)
        self.add(self.carried)

    def add(self, tokens: list[bytes]) -> None:
        if not tokens:
            return
        self.parts.append(np.array(list(map(self.ids.__getitem__, tokens)), np.int64))
        self.size += len(tokens)

    def sequence(self) -> np.ndarray:
        """All ids, a separator first and last, never two in a row."""
        ids = np.concatenate([[0], *self.parts, [0]])
        return ids[np.concatenate([[True], (ids[1:] != 0) | (ids[:-1] != 0)])]

    def tail(self, words: list[bytes]) -> list[bytes]:
        """The last DEPTH - 1 words, of an unfinished piece."""
        out = []
        last = np.concatenate([[0], *[p[1 - DEPTH:] for p in self.parts[1 - DEPTH:]]]) if self.parts else np.zeros(1, np.int64)
        for i in last[1 - DEPTH:][::-1]:
            if i == 0:
                break
            out.append(words[i])
        return out[::-1]


class Index:
    """Bidirectional index of one sequence of ids."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.most = ids, int(ids.max()) + 1
        if self.most >= 1 << ID_BITS:
            raise ValueError("too many words for one shard")
        self.below = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=self.most))])

    @cached_property
    def backward(self) -> np.ndarray:
        """Transform of what stands before: left extensions."""
        return self.transform(-1)

    @cached_property
    def forward(self) -> np.ndarray:
        """Transform of what stands after: right extensions."""
        return self.transform(1)

    def transform(self, step: int) -> np.ndarray:
        """Symbol beside each row, of rows sorted by the DEPTH ids that follow
        in the direction away from ``step``."""
        key = np.zeros(len(self.ids), np.int64)
        for k in range(DEPTH):
            key = (key << ID_BITS) | np.roll(self.ids, k * step)
        return self.ids[(np.argsort(key) + step) % len(self.ids)].astype(np.int32)

    @staticmethod
    def leads(symbols: np.ndarray) -> np.ndarray:
        """The row that each row leads to: C[symbol] plus the symbol's rank.  Rows
        of one symbol keep their order."""
        out = np.empty(len(symbols), np.int32)
        out[np.argsort(symbols * np.int64(len(symbols)) + np.arange(len(symbols)))] = np.arange(len(symbols), dtype=np.int32)
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(id, start in the left index, start in the right one, count) of all."""
        ids = np.flatnonzero(np.diff(self.below))
        ids = ids[ids != 0]
        return ids, self.below[ids], self.below[ids], self.below[ids + 1] - self.below[ids]

    def extend(self, symbols: np.ndarray, here: np.ndarray, there: np.ndarray, counts: np.ndarray, onward: bool = False):
        """(owner, symbol, start here, start there, count) of every extension of
        the intervals that start at ``here`` in the index of ``symbols`` and at
        ``there`` in the other one.  The start here, which only a further
        extension to the same side needs, is 0 unless ``onward``."""
        first = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(counts)), counts)
        at = np.arange(int(counts.sum())) - first[owner] + here[owner]
        key = owner * np.int64(self.most) + symbols[at]
        if onward:
            order = np.argsort(key)
            at, key = at[order], key[order]
        else:
            key.sort()
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        size = np.diff(np.append(start, len(key)))
        lead = np.minimum.reduceat(self.leads(symbols)[at], start) if onward and len(start) else np.zeros(len(start), np.int64)
        own, sym = np.divmod(key[start], np.int64(self.most))
        words = sym != 0
        return tuple(v[words] for v in (own, sym, lead.astype(np.int64), there[own] + start - first[own], size))

    def pairs(self, onward: bool = False):
        """(left id, right id, start in the left index, start in the right one,
        count) of all word pairs: right extensions of the words."""
        ids, left, right, counts = self.words()
        own, sym, right, left, size = self.extend(self.forward, right, left, counts, onward)
        return ids[own], sym, left, right, size

    def triples(self, pairs, kept: np.ndarray):
        """(ids, count) of the left extensions of the pairs in ``kept`` whose
        left pair is in it too."""
        x, y, left, right, counts = (v[kept] for v in pairs)
        own, sym, _, _, size = self.extend(self.backward, left, right, counts)
        known = x << ID_BITS | y  # in order: pairs come sorted
        key = sym << ID_BITS | x[own]
        at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
        good = known[at] == key if len(known) else np.zeros(len(key), bool)
        return sym[good], x[own][good], y[own][good], size[good]


def counted(docs: DataFrame, emit, shard_words: int = SHARD_WORDS, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(lang, phrase, words, f) rows that ``emit(lang, words, index, carried)``
    yields of every shard, as (a column for each word, counts)."""
    def rows(batches):
        open_shards: dict[str, Shard] = {}

        def closed(lang: str):
            shard = open_shards.pop(lang)
            words = list(shard.ids)
            held = shard.tail(words)
            if held:
                open_shards[lang] = Shard(held)
            ids = shard.sequence()
            if len(ids) > 2:
                for columns, f in emit(lang, pa.array(words, pa.binary()), Index(ids), shard.carried):
                    for i in range(0, len(f), 1 << 16):
                        parts, n = [c.slice(i, 1 << 16) for c in columns], min(1 << 16, len(f) - i)
                        phrases = joined(parts).cast(pa.string()) if parts else pa.repeat(pa.scalar(""), n)
                        yield pa.RecordBatch.from_arrays(
                            [pa.repeat(pa.scalar(lang), n), phrases, pa.array(np.full(n, len(parts), np.int32)), pa.array(f[i:i + n], pa.int64())],
                            names=["lang", "phrase", "words", "f"])

        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for tokens in tokens_of(text.as_buffer().to_pybytes().translate(READ), slice_bytes):
                    if lang not in open_shards:
                        open_shards[lang] = Shard()
                    open_shards[lang].add(tokens)
                    size += len(tokens)
                    if size >= shard_words:
                        for name in list(open_shards):
                            yield from closed(name)
                        size = 0
        for name in list(open_shards):
            yield from closed(name)

    plain = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(rows, "lang string, phrase string, words int, f long").groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))


def joined(columns):
    """Words side by side, a blank between them."""
    return pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.binary())) if len(columns) > 1 else columns[0]


def short_phrases(lang, words, index, carried):
    """Words, pairs and (as the empty phrase) the number of words of a shard;
    what the shard before has counted already is taken off."""
    ids, _, _, f = index.words()
    yield [words.take(pa.array(ids))], f
    yield [], np.array([f.sum() - len(carried)])
    if carried:
        again = pa.array(carried, pa.binary())
        yield [again], np.full(len(again), -1)
        yield [again[:-1], again[1:]], np.full(len(again) - 1, -1)
    x, y, _, _, f = index.pairs()
    yield [words.take(pa.array(x)), words.take(pa.array(y))], f


def bitmap_of(pairs: DataFrame) -> bytes:
    """A bit for the hash of each (lang, phrase): a filter, of a fixed size."""
    slot = pair_slot()
    words = (pairs.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 31 as int)))").alias("bits")).toArrow())
    out = np.zeros(1 << (BITS - 5), np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def pair_slot() -> Column:
    """A bit's place from the hashes of the two words: ``slots_of`` on columns."""
    word = F.split("phrase", " ")
    one, two = (F.xxhash64(F.concat_ws("\n", "lang", word[k])) for k in (0, 1))
    return one.bitwiseXOR(F.shiftrightunsigned(two, 23)).bitwiseXOR(F.shiftleft(two, 5)).bitwiseAND(F.lit((1 << BITS) - 1))


def slots_of(lang: str, words: list[bytes], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bitmap places of word pairs; each word is hashed once."""
    head = f"{lang}\n".encode()
    hashes = np.fromiter((xxhash.xxh64_intdigest(head + w, SPARK_SEED) for w in words), np.uint64, len(words))
    one, two = hashes[x], hashes[y]
    return ((one ^ (two >> np.uint64(23)) ^ (two << np.uint64(5))) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def triple_counts(docs: DataFrame, frequent_pairs: DataFrame) -> DataFrame:
    bitmap = docs.sparkSession.sparkContext.broadcast(bitmap_of(frequent_pairs))

    def emit(lang, words, index, carried):
        pairs = index.pairs()
        slots = slots_of(lang, words.to_pylist(), *pairs[:2])
        kept = (bitmap.value[slots >> 5] >> (slots & 31).astype(np.uint32)) & 1 == 1
        *ids, f = index.triples(pairs, kept)
        yield [words.take(pa.array(i)) for i in ids], f

    return counted(docs, emit)


#: Ways a word's row is repeated for the lookups: one word may be in a third of
#: the phrases.
SALTS = 8


def phrase_counts(docs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, words, f): phrases of one to three words with ``least``
    occurrences or more, and each language's number of words as the empty one."""
    with arrow_rows(docs.sparkSession, ROWS_AT_ONCE):
        short = staged(counted(docs, short_phrases).where((F.col("f") >= least) | (F.col("words") == 0)), "phrases-short")
        triples = triple_counts(docs, short.where("words = 2")).where(F.col("f") >= least)
        return staged(short.unionByName(triples), "phrases")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the phrases of two and three
    words by their lowest cut, without those that a longer one covers."""
    word = F.split("phrase", " ")
    cuts = F.when(F.col("words") == 2, F.array(F.struct(F.lit(1).alias("k"), word[0].alias("l"), word[1].alias("r")))).otherwise(
        F.array(F.struct(F.lit(1).alias("k"), word[0].alias("l"), F.concat_ws(" ", word[1], word[2]).alias("r")),
                F.struct(F.lit(2).alias("k"), F.concat_ws(" ", word[0], word[1]).alias("l"), word[2].alias("r"))))
    whole = counts.where("words >= 2").withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    ends = whole.select("lang", "phrase", "words", F.col("f").alias("a"), "salt", F.explode(cuts).alias("c"))
    parts = ends.select("lang", "phrase", "words", "a", "salt", F.col("c.k").alias("k"), F.explode(F.array(
        F.struct(F.lit(True).alias("left"), F.col("c.l").alias("part")), F.struct(F.lit(False).alias("left"), F.col("c.r").alias("part")))).alias("e")).select("*", "e.*").drop("e")
    table = counts.where("words in (1, 2)").select("lang", F.col("phrase").alias("part"), F.col("f").alias("part_f"), F.explode(F.expr(f"sequence(0, {SALTS - 1})")).alias("salt"))
    found = parts.join(table, ["lang", "part", "salt"])
    cut = found.groupBy("lang", "phrase", "words", "a", "k").agg(F.max(F.when(F.col("left"), F.col("part_f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("part_f"))).alias("r"))
    score = F.expr("cast(1000000 as decimal(7,0)) * cast(a as decimal(16,0)) * cast(a as decimal(16,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cut.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    # the most frequent longer phrase that a pair lies in
    longer = whole.where("words = 3").select("lang", F.col("f").alias("longer"), F.explode(F.array(F.concat_ws(" ", word[0], word[1]), F.concat_ws(" ", word[1], word[2]))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < 50 * F.col("a")))
    return kept.select("lang", "phrase", "words", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), F.col("m.score").alias("score"))


def collocations(docs: DataFrame, least: int = 10, top: int = 2000) -> DataFrame:
    """Each language's ``top`` phrases by score."""
    counts = phrase_counts(docs, least)
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = scored(counts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
