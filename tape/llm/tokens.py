"""Token counts of texts by a two-tier lookup on the map side.

A byte-level BPE tokenizer first cuts a text into pre-tokens and then encodes
each by itself, so a text's token count is the sum of its pre-tokens' lengths.

1. *Table* (first tier): lengths of frequent pre-tokens, broadcast once.  It
   holds the vocabulary's own pre-tokens and the most frequent ones of a sample
   of documents: at most vocabulary + ``TABLE_SIZE`` entries on any corpus.
2. *Worker cache* (second tier): a pre-token that the table lacks is encoded by
   the library once and remembered in the Python worker, over all its tasks.  A
   full cache (``CACHE_SIZE`` entries) starts anew.

No pre-token is ever shuffled; the sample (each row drawn by itself, about
``SAMPLE_ROWS`` in all) shapes only the speed, never a count.

The cutting pattern is run by ``regex``, whose Unicode tables are newer than the
library's.  A text with a character that is not sure (``is_sure``; a test checks that
both agree on every one that is) is encoded by the library as a whole.

Special tokens: their strings inside a text count one token each, as the library
does by default.

Defined cases: null text is empty: 0 bytes, 0 tokens, not over the limit; null or
repeated ids and equal rows give a row each, as they came; an empty table gives
an empty result; ties do not occur.  Very long texts are cut in slices of
``SLICE`` characters, where a blank between two ASCII letters starts a pre-token
anyway; without such a place a text is taken whole, and pre-tokens above
``LONGEST`` characters are encoded but not remembered.  Columns other than id
and text, whatever their names, are ignored.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections import Counter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TABLE_SIZE = 1 << 16
CACHE_SIZE = 1 << 18
SAMPLE_ROWS = 1024
#: Most frequent pre-tokens that one sampled text adds.
SAMPLE_PIECES = 512
#: Longest pre-token, in characters, that a table or cache holds.
LONGEST = 48
SLICE = 1 << 20

#: The cutting pattern of byte-level BPE files (a fixed value).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: The same for ASCII texts, in the standard library's faster matcher.
PLAIN_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
BREAK = regex.compile(r"[A-Za-z](?= [A-Za-z])")


#: Characters that were found sure: a worker's memory of ``is_sure``.
_SURE: set[str] = set()


def is_sure(text: str) -> bool:
    """Whether Unicode 3.2 had assigned all characters: the class of a newer one
    may differ between two versions of the tables."""
    if text.isascii():
        return True
    new = set(text) - _SURE
    old = unicodedata.ucd_3_2_0.category
    sure = {c for c in new if old(c) != "Cn"}
    _SURE.update(sure)
    return len(sure) == len(new)


def slices(text: str, most: int = SLICE):
    """``text`` in parts whose pre-tokens are those of the whole."""
    at = 0
    while len(text) - at > most:
        found = BREAK.search(text, at + most)
        if found is None:
            break
        yield text[at:found.end()]
        at = found.end()
    yield text[at:] if at else text


def pieces(text: str) -> list[str]:
    return (PLAIN_PIECES if text.isascii() else PIECES).findall(text)


class Lengths(dict):
    """Token counts of pre-tokens: the table, then the cache, then the library."""

    def __init__(self, tokenizer, table: dict):
        super().__init__()
        self.tokenizer, self.table = tokenizer, table
        self.specials = regex.compile("|".join(regex.escape(t.content) for t in sorted(tokenizer.get_added_tokens_decoder().values(), key=lambda t: -len(t.content))) or r"(?!)")

    def __missing__(self, piece: str) -> int:
        n = self.table.get(piece)
        if n is None:
            n = self.whole(piece)
            if len(piece) <= LONGEST:
                if len(self) >= CACHE_SIZE:
                    self.clear()
                self[piece] = n
        return n

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count(self, text: str) -> int:
        if not is_sure(text):
            return self.whole(text)
        n = 0
        parts = self.specials.split(text)
        for part in parts:
            for cut in slices(part):
                n += sum(map(self.__getitem__, pieces(cut)))
        return n + len(parts) - 1


def check_kind(raw: str) -> None:
    """Only files whose pre-tokens are the pattern's can be counted this way."""
    spec = json.loads(raw)
    cut = spec.get("pre_tokenizer") or {}
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in spec.get("added_tokens") or [])
    if cut.get("type") != "ByteLevel" or not cut.get("use_regex", True) or cut.get("add_prefix_space") or spec.get("normalizer") or not plain:
        raise ValueError("not a plain byte-level BPE file: no normalizer, no prefix space, plain special tokens")


def load(raw: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    found = Tokenizer.from_str(raw)
    found.no_truncation()
    found.no_padding()
    return found


def vocabulary_pieces(tokenizer) -> list[str]:
    """The vocabulary's entries that are whole pre-tokens."""
    out = []
    for i in range(tokenizer.get_vocab_size(with_added_tokens=False)):
        text = tokenizer.decode([i], skip_special_tokens=False)
        if "�" not in text and len(text) <= LONGEST and PIECES.fullmatch(text) and is_sure(text):
            out.append(text)
    return out


def frequent_pieces(docs: DataFrame, text: str) -> list[str]:
    """The most frequent pre-tokens of a sample of the documents."""
    total = docs.count()
    if not total:
        return []
    drawn = docs.sample(min(1.0, SAMPLE_ROWS / total), seed=11)
    sample = drawn.where(F.col(text).isNotNull()).select(F.col(text).alias("text"))

    def rows(batches):
        for batch in batches:
            for value in batch.column(0):
                found = Counter()
                for cut in slices(value.as_py()):
                    found.update(pieces(cut))
                best = [(p, n) for p, n in sorted(found.items(), key=lambda e: (-e[1], e[0])) if len(p) <= LONGEST][:SAMPLE_PIECES]
                yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in best], pa.string()), pa.array([n for _, n in best], pa.int64())], names=["piece", "n"])

    found = sample.mapInArrow(rows, "piece string, n long").toArrow()
    counts = Counter()
    for piece, n in zip(found.column("piece").to_pylist(), found.column("n").to_pylist()):
        counts[piece] += n
    return [p for p, _ in sorted(counts.items(), key=lambda e: (-e[1], e[0]))[:TABLE_SIZE]]


def length_table(raw: str, frequent: list[str]) -> tuple[list[str], bytes]:
    """(pre-tokens, their token counts, a byte each)."""
    tokenizer = load(raw)
    found = sorted(p for p in {*vocabulary_pieces(tokenizer), *frequent} if is_sure(p))
    return found, bytes(len(tokenizer.encode(p, add_special_tokens=False).ids) for p in found)


#: Each Python worker's caches, by tokenizer: they outlive a task.
_WORKER: dict[int, Lengths] = {}


def worker_lengths(name: int, raw: str, table: tuple[list[str], bytes]) -> Lengths:
    if name not in _WORKER:
        _WORKER.clear()
        _WORKER[name] = Lengths(load(raw), dict(zip(*table)))
    return _WORKER[name]


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ``n_bytes``, ``n_tokens``, ``over_limit``) of every whole text.
    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers library."""
    with open(tokenizer, encoding="utf-8") as f:
        raw = f.read()
    check_kind(raw)
    plain = docs.select(F.col(key), F.col(text))
    table = length_table(raw, frequent_pieces(plain, text))
    shared = docs.sparkSession.sparkContext.broadcast((raw, table))
    name = hash((raw, table[1], len(table[0])))
    kind = plain.schema[key].dataType.simpleString()

    def rows(batches):
        lengths = worker_lengths(name, *shared.value)
        for batch in batches:
            found = [lengths.count(t.as_py()) if t.is_valid else 0 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    sized = plain.select(key, text, F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("n_bytes"))
    counted = sized.mapInArrow(rows, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(key), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
