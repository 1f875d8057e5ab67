"""Benchmark decontamination by Wu-Manber search over words.

Test strings are the windows of ``size`` consecutive words of the benchmark
items; an item of fewer words, but not none, is one test string.  Strings of
one length m are searched together: the last two words before a position look
up how far the position can move on without passing over an occurrence (the
block shift table; m - 1 words where no test string has that block).  Shift 0
selects the bucket of the strings that end in the block, and their words are
compared directly.

The benchmark is read in blocks of about ``BLOCK_BYTES`` of text, so what goes
to the tasks has a bound; every block is one more pass of the same task over
its rows, without a shuffle.

Defined cases: null or empty text has no words and no hits; null or empty items
have no test strings; items without id mark words but are not counted or named;
an id that repeats counts once; rows of documents are never merged.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from .common import fresh

#: Text of benchmark items that one pass searches for.
BLOCK_BYTES = 1 << 20
#: Words after A-Z are lower-cased; on UTF-8 bytes the class is the same.
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(raw: bytes) -> list[bytes]:
    return re.findall(WORD, raw.lower())  # bytes.lower() changes A-Z only


class WuManber:
    """Shift and hash tables of the test strings of one length."""

    def __init__(self, strings: dict[tuple, set], length: int):
        self.strings, self.length = strings, length
        self.block = 2 if length > 1 else 1
        self.most = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, list[tuple]] = {}
        for s in strings:
            for end in range(self.block, length + 1):
                key = s[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.most), length - end)
            self.bucket.setdefault(s[length - self.block:], []).append(s)

    def search(self, words: list[bytes]):
        """Yield (first word, items) of every occurrence."""
        shift, most, block, length, n = self.shift.get, self.most, self.block, self.length, len(words)
        end = length
        while end <= n:
            tail = tuple(words[end - block:end])
            step = shift(tail, most)
            if step:
                end += step
                continue
            here = tuple(words[end - length:end])
            for s in self.bucket[tail]:
                if s == here:
                    yield end - length, self.strings[s]
            end += 1


def matchers(items: list[tuple], size: int) -> list[WuManber]:
    """items: (id or None, text)."""
    by_length: dict[int, dict[tuple, set]] = {}
    for item, text in items:
        w = words_of((text or "").encode())
        m = min(size, len(w))
        if m:
            strings = by_length.setdefault(m, {})
            for k in range(len(w) - m + 1):
                strings.setdefault(tuple(w[k:k + m]), set()).update([] if item is None else [str(item)])
    return [WuManber(strings, m) for m, strings in sorted(by_length.items())]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search_block(df: DataFrame, text: str, names: list[str], items: list[tuple], size: int, again: bool) -> DataFrame:
    fields = [StructField(names[0], LongType()), StructField(names[1], ArrayType(IntegerType())), StructField(names[2], ArrayType(IntegerType())), StructField(names[3], ArrayType(StringType()))]
    plain = [f for f in df.schema.fields if f.name not in names]
    schema = StructType([*plain, *fields])

    def rows(batches):
        tables = matchers(items, size)
        for batch in batches:
            texts = batch.column(text)
            n_words, starts, ends, found = [], [], [], []
            for k in range(len(texts)):
                w = words_of(texts[k].as_buffer().to_pybytes()) if texts[k].is_valid else []
                spans, names_found = [], set()
                if again:
                    spans = list(zip(batch.column(names[1])[k].as_py(), batch.column(names[2])[k].as_py()))
                    names_found.update(batch.column(names[3])[k].as_py())
                for t in tables:
                    for at, who in t.search(w):
                        spans.append((at, at + t.length))
                        names_found |= who
                spans = merged(spans)
                n_words.append(len(w))
                starts.append([a for a, _ in spans])
                ends.append([b for _, b in spans])
                found.append(sorted(names_found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in plain] + [pa.array(n_words, pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32())), pa.array(found, pa.list_(pa.string()))],
                names=schema.names)

    return df.mapInArrow(rows, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, text: str = "text", item: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[str]]:
    """``docs`` with five more columns, and their names: n_words, hit_starts and
    hit_ends (disjoint word spans in order), hit_items (sorted), n_hit."""
    names = fresh(docs, "n_words", "hit_starts", "hit_ends", "hit_items", "n_hit")
    tests = benchmark.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    total = tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    out = docs
    for k in range(blocks):
        part = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()
        out = _search_block(out, text, names[:4], [tuple(r) for r in part], size, k > 0)
    spans = F.zip_with(names[2], names[1], lambda b, a: (b - a).cast("long"))
    return out.withColumn(names[4], F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x)), names


def contamination_report(docs: DataFrame, benchmark: DataFrame, size: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The counts and digests for each document."""
    found, _ = find_contamination(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), benchmark, size)
    return found.select(
        F.col("doc_id").alias(key), "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def without_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 10, text: str = "text") -> DataFrame:
    """``docs`` without the documents that contain a test string."""
    found, names = find_contamination(docs, benchmark, size, text)
    return found.where(F.col(names[4]) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
