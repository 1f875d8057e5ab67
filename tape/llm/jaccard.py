"""Exact n-gram Jaccard self-join by multiple global token orders.

A document is its set of distinct word shingles.  Sets x and y with similarity
t or more share a token in their prefixes - the first ``n - ceil(t n) + 1``
tokens - under *every* total order of the tokens.  In fact they
share several (see ``least_common``).  So a pair is a candidate only if its
prefixes meet in that many tokens under each of several orders; what one order
alone lets through, the others stop before the sets are compared.

All orders put frequent tokens last (by a fixed-size count sketch over all
documents), so that a passage that many documents share is not in their
prefixes; within the rare tokens each order is another permutation.  The sketch
only shapes the orders: any sketch gives the same links.

1. Documents with equal sets form a class, named by a 64-bit hash of the set;
   from here on one document stands for its class.
2. Prefix tokens of the first order meet on the token.  Those that two classes
   share are found from the bare tokens, packed by hash bucket; a bitmap of them,
   of a fixed size, keeps most others from the shuffles that follow.  Of a token's
   classes only the pairs (class, centre) are formed, a star instead of all pairs;
   each class keeps the centre with which it shares most tokens.
3. These pairs are measured on whole sets; connected components of the links
   follow.
4. Every pair of classes that may still be linked and are in different
   components (``crossing_pairs``) must meet under the other orders too, and is
   then verified on whole sets.  A link inside a
   component cannot change it, so no link is lost; near copies by the thousand
   cost a star, not a square.

Hashes: 64 bits for tokens and classes, 48 bits inside a pair of sets (a wrong
match has odds of about n*n / 2**48 a pair).

Defined cases: null or empty text has the empty set and no links; fewer words
than a shingle make one shingle; equal rows are one class; ids may repeat or be
null: a text is found by a 64-bit hash of its id and text (``row_key``), and a
class whose ids are all null links like any other; ties do not matter.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, ascii_lower, flagged, fresh, id_bitmap, settings, staged
from .components import connected_components
from .texts import SPACE, chunks, mix, runs, shingle_hashes, word_hashes

#: Counters of the frequency sketch: 8 MB in all, whatever the corpus; a task
#: sends them in blocks of SKETCH_BLOCK.
SKETCH_BITS = 20
SKETCH_BLOCK = 1 << 13
#: Bits of the bitmap of shared tokens: 8 MB, whatever their number.
SHARED_BITS = 26
#: Prefix tokens that are counted together.
BUCKET_TOKENS = 1 << 20
#: Rows of texts or sets that are sent to Python at once.
ROWS_AT_ONCE = 1000
#: Permutations of the token orders; the first one forms the candidates.
ORDER_SEEDS = (0x5851F42D4C957F2D, 0x14057B7EF767814F, 0x2545F4914F6CDD1D)
PACKED = 6  # bytes of a shingle hash inside a packed set


def shingles_of(data: np.ndarray, offs: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = runs(~SPACE[data], offs)
    return shingle_hashes(word_hashes(data, starts, ends), first, size)


def set_class(tokens: np.ndarray) -> int:
    """Hash of a sorted set, as a signed 64-bit number."""
    with np.errstate(over="ignore"):
        place = np.arange(1, len(tokens) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return int(mix(np.array([mix(tokens ^ mix(place)).sum() + np.uint64(len(tokens))], np.uint64))[0].astype(np.int64))


def pack(tokens: np.ndarray) -> bytes:
    short = np.sort(tokens & np.uint64((1 << 8 * PACKED) - 1))
    return np.ascontiguousarray(short.view(np.uint8).reshape(-1, 8)[:, :PACKED]).tobytes()


def unpack(raw) -> np.ndarray:
    part = np.frombuffer(raw, np.uint8).reshape(-1, PACKED)
    full = np.zeros((len(part), 8), np.uint8)
    full[:, :PACKED] = part
    return full.view(np.uint64).ravel()


def row_key(key: str, text: str) -> Column:
    """A row by its id and text: ids may repeat or be null."""
    return F.xxhash64(key, text)


def frequency_sketch(texts: DataFrame, size: int) -> np.ndarray:
    """Token counts of all texts in 2**SKETCH_BITS counters.  Each task sends
    its counters once, packed; Spark sums them, and the sums alone reach the
    driver."""
    bits, width = SKETCH_BITS, SKETCH_BLOCK

    def count(batches):
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for _, _, data, offs in chunks(batch.column("text")):
                tokens, _ = shingles_of(data, offs, size)
                total += np.bincount((tokens & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
        blocks = total.reshape(-1, width)
        for k in np.flatnonzero(blocks.any(1)).tolist():
            small = blocks[k].astype(np.min_scalar_type(int(blocks[k].max())))  # as many bytes as the counts need
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([small.tobytes()], pa.binary())], names=["block", "counts"])

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for raw in table.column("counts"):
            data = raw.as_buffer()
            total += np.frombuffer(data, f"u{data.size // width}").astype(np.int64)
        return pa.Table.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["block", "counts"])

    found = texts.mapInArrow(count, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, counts binary").toArrow()
    sketch = np.zeros((1 << bits) // width * width, np.int64).reshape(-1, width)
    for block, raw in zip(found.column("block").to_pylist(), found.column("counts").to_pylist()):
        sketch[block] = np.frombuffer(raw, np.int64)
    return sketch.ravel()


def order_levels(sketch: np.ndarray) -> np.ndarray:
    """A level for each counter: 0 up to the noise of the sketch, then by the
    power of two of what exceeds it.  Frequent tokens have high levels."""
    mean = sketch.mean() if len(sketch) else 0.0
    over = np.maximum(0.0, sketch - (mean + 3 * np.sqrt(mean) + 3))
    return np.ceil(np.log2(over + 1)).astype(np.uint64)


def prefix(tokens: np.ndarray, levels: np.ndarray, seed: int, percent: int) -> np.ndarray:
    """The prefix tokens of one set under the order of ``seed``; ``levels`` are
    those of the sketch's counters."""
    n = len(tokens)
    keep = n - (percent * n + 99) // 100 + 1
    if keep >= n:
        return tokens
    level = levels[(tokens & np.uint64(len(levels) - 1)).astype(np.int64)].astype(np.uint64)
    order = (level << np.uint64(58)) | (mix(tokens ^ np.uint64(seed)) >> np.uint64(6))
    return tokens[np.argpartition(order, keep - 1)[:keep]]


def document_classes(texts: DataFrame, size: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """(doc_id, row, n, class, first) of (doc_id, text, row): set size, class and the
    prefix tokens under the first order, null where the task has met the class
    already."""
    levels, seed = order_levels(sketch).astype(np.uint8), ORDER_SEEDS[0]

    def rows(batches):
        met = set()
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("row")
            for i, j, data, offs in chunks(batch.column("text")):
                every, bounds = shingles_of(data, offs, size)
                n, cls, first = [], [], []
                for k in range(j - i):
                    tokens = np.unique(every[bounds[k]:bounds[k + 1]])
                    n.append(len(tokens))
                    name = set_class(tokens) if len(tokens) else None
                    cls.append(name)
                    known = name is None or name in met
                    first.append(None if known else prefix(tokens, levels, seed, percent).view(np.int64))
                    if not known:
                        met.add(name)
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i), keys.slice(i, j - i), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(first, pa.list_(pa.int64()))], names=["doc_id", "row", "n", "class", "first"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"doc_id {kind}, row long, n long, class long, first array<long>")


def class_sets(texts: DataFrame, wanted: DataFrame, size: int, percent: int, sketch: np.ndarray) -> DataFrame:
    """(class, tokens, other0, ...): packed set, and prefixes under the further
    orders, of each (row, class) in ``wanted``.  A bitmap of the wanted rows,
    of a fixed size, keeps most other texts out of the shuffle."""
    levels, seeds = order_levels(sketch).astype(np.uint8), ORDER_SEEDS[1:]
    near = flagged(texts.select("row", "text"), F.col("row"), id_bitmap(wanted, "row"), "near").where("near")
    found = near.join(wanted, "row").select("class", "text")

    def rows(batches):
        met = set()
        for batch in batches:
            names = batch.column("class").to_pylist()
            for i, j, data, offs in chunks(batch.column("text")):
                every, bounds = shingles_of(data, offs, size)
                sets = [np.unique(every[bounds[k]:bounds[k + 1]]) for k in range(j - i)]
                good = []
                for k, s in enumerate(sets):  # equal rows come once from a task
                    if names[i + k] not in met and len(s) and set_class(s) == names[i + k]:
                        met.add(names[i + k])
                        good.append(k)
                orders = [pa.array([prefix(sets[k], levels, seed, percent).view(np.int64) for k in good], pa.list_(pa.int64())) for seed in seeds]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i + k] for k in good], pa.int64()), pa.array([pack(sets[k]) for k in good], pa.binary()), *orders],
                    names=["class", "tokens"] + [f"other{k}" for k in range(len(seeds))])

    return found.mapInArrow(rows, "class long, tokens binary" + "".join(f", other{k} array<long>" for k in range(len(seeds))))


def measured(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, distance, linked) of (a, b, set_a, set_b): the Jaccard distance,
    and whether the similarity is reached (in whole numbers)."""
    def rows(batches):
        for batch in batches:
            distance, linked = [], []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                left, right = unpack(x.as_buffer()), unpack(y.as_buffer())
                at = np.minimum(np.searchsorted(left, right), len(left) - 1)
                both = int((left[at] == right).sum())
                union = len(left) + len(right) - both
                distance.append(1 - both / union)
                linked.append(100 * both >= percent * union)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(distance, pa.float64()), pa.array(linked, pa.bool_())], names=["a", "b", "distance", "linked"])

    return pairs.mapInArrow(rows, "a long, b long, distance double, linked boolean")


def least_common(n_a, n_b, percent: int):
    """Prefix tokens that two linked sets of these sizes share at least.

    They share o = ceil(t / (1 + t) * (n_a + n_b)) tokens or more, so at most
    n - o of a prefix are not in the other set.  Of the two prefixes, the one
    that ends first in the order has all its common tokens in the other."""
    both = F.ceil(percent * (n_a + n_b) / F.lit(100 + percent) - F.lit(1e-9))
    bounds = [n - F.ceil(percent * n / F.lit(100) - F.lit(1e-9)) + 1 - (n - both) for n in (n_a, n_b)]
    return F.greatest(F.lit(1), F.least(*bounds))


def confirmed(pairs: DataFrame, classes: DataFrame, sets_of, percent: int, name: str, all_orders: bool = True) -> DataFrame:
    """Candidate ``pairs`` (a, b) of classes, measured: the sizes must fit, then
    the prefixes under every further order (unless the distances of all pairs
    are wanted), then the sets are compared."""
    x, y = (classes.select(*[F.col(c).alias(f"{c}_{end}") for c in ("class", "n", "row")]) for end in "ab")
    joined = pairs.join(x, F.col("a") == F.col("class_a")).join(y, F.col("b") == F.col("class_b"))
    joined = joined.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).withColumn("least", least_common(F.col("n_a"), F.col("n_b"), percent))
    kept = staged(joined.select("a", "b", "least", "row_a", "row_b"), f"{name}-candidates")
    ends = [kept.select(F.col(f"row_{e}").alias("row"), F.col(e).alias("class")) for e in "ab"]
    sets = staged(sets_of(ends[0].unionByName(ends[1]).distinct()), f"{name}-sets")
    orders = [c for c in sets.columns if c.startswith("other")]
    left, right = (sets.select(F.col("class").alias(e), F.col("tokens").alias(f"set_{e}"), *[F.col(o).alias(f"{o}_{e}") for o in orders]) for e in "ab")
    meet = reduce(and_, [F.size(F.array_intersect(f"{o}_a", f"{o}_b")) >= F.col("least") for o in orders])
    met = kept.select("a", "b", "least").join(left, "a").join(right, "b")
    met = met.where(meet) if all_orders else met
    return staged(measured(met.select("a", "b", "set_a", "set_b"), percent), f"{name}-links")


def one_of_class(found: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, n, first) of each class once.  Only classes that several tasks
    have met are shuffled with their tokens."""
    again = staged(id_bitmap(classes.where("carriers > 1"), "class"), "jaccard-again")
    rows = flagged(found.where("first is not null").select("class", "n", "first"), F.col("class"), again, "again")
    alone = rows.where("not again").drop("again")
    return alone.unionByName(rows.where("again").groupBy("class").agg(F.first("n").alias("n"), F.first("first").alias("first")))


def common_tokens(firsts: DataFrame, total: int) -> DataFrame:
    """(token, df): the prefix tokens of two classes or more, and of how many.
    The tokens (``total`` or a little less) are dealt by hash to buckets of about
    ``BUCKET_TOKENS`` and go there packed, each once from a batch with its count."""
    buckets = 1 + total // BUCKET_TOKENS

    def deal(batches):
        for batch in batches:
            tokens, counts = np.unique(batch.column(0).flatten().to_numpy().view(np.uint64), return_counts=True)
            bucket = ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            tokens, counts, bucket = tokens[order], counts[order].astype(np.uint32), bucket[order]
            start = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(start[1:], len(bucket))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[start], pa.int64()), pa.array([tokens[i:j].tobytes() for i, j in zip(start, ends)], pa.binary()), pa.array([counts[i:j].tobytes() for i, j in zip(start, ends)], pa.binary())],
                names=["bucket", "tokens", "counts"])

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tokens = np.concatenate([np.frombuffer(t.as_buffer(), np.uint64) for t in table.column("tokens")])
        counts = np.concatenate([np.frombuffer(c.as_buffer(), np.uint32) for c in table.column("counts")])
        order = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[order], counts[order].astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
        df = np.add.reduceat(counts, start) if len(start) else counts
        many = df > 1
        return pa.Table.from_arrays([pa.array(tokens[start][many].view(np.int64), pa.int64()), pa.array(df[many], pa.int64())], names=["token", "df"])

    dealt = firsts.select("first").mapInArrow(deal, "bucket long, tokens binary, counts binary")
    return dealt.groupBy("bucket").applyInArrow(count, "token long, df long")


def token_bitmap(common: DataFrame) -> np.ndarray:
    """A bit for the low bits of each token: a filter of a fixed size."""
    slot = F.col("token").bitwiseAND(F.lit((1 << SHARED_BITS) - 1))
    words = common.groupBy(F.shiftright(slot, 5).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(token & 31 as int)))").alias("bits")).toArrow()
    out = np.zeros(1 << (SHARED_BITS - 5), np.uint32)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return out


def shared_tokens(found: DataFrame, classes: DataFrame) -> DataFrame:
    """(token, class, n, prefix, df, rank, hub): the prefix tokens that two
    classes or more have, in how many they are, their place among the class's
    prefix tokens from the most frequent one down (one global order), and how
    common the class's prefix is."""
    firsts = one_of_class(found, classes)
    total = found.agg(F.sum(F.when(F.col("first").isNotNull(), F.size("first").cast("long")))).first()[0] or 0
    common = staged(common_tokens(firsts, total), "jaccard-common")
    bitmap = found.sparkSession.sparkContext.broadcast(token_bitmap(common))

    def keep(batches):
        for batch in batches:
            lists = batch.column("first")
            tokens = lists.flatten().to_numpy().view(np.uint64)
            slot = tokens & np.uint64((1 << SHARED_BITS) - 1)
            good = (bitmap.value[(slot >> np.uint64(5)).astype(np.int64)] >> (slot & np.uint64(31)).astype(np.uint32)) & 1 == 1
            size = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(size)), size)[good]
            columns = [batch.column(c).take(pa.array(row)) for c in ("class", "n")]
            for i in range(0, len(row), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[good][i:i + (1 << 16)].view(np.int64)), *(c.slice(i, 1 << 16) for c in columns), pa.array(size[row[i:i + (1 << 16)]], pa.int64())],
                    names=["token", "class", "n", "prefix"])

    rows = firsts.select("class", "n", "first").mapInArrow(keep, "token long, class long, n long, prefix long").join(common, "token")
    of = Window.partitionBy("class")
    down = of.orderBy(F.desc("df"), F.desc("token"))
    shared = staged(rows.withColumn("rank", F.row_number().over(down)).withColumn("hub", F.sum("df").over(of) / F.col("prefix")), "jaccard-shared")
    bitmap.destroy()
    return shared


def may_link(percent: int):
    """Whether rows (n, rank) of a token in two classes, ``_a`` and ``_b``, can
    be the rarest common token of linked sets."""
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return fits & (F.least("rank_a", "rank_b") >= least_common(F.col("n_a"), F.col("n_b"), percent))


def star_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """(a, b): each class with one centre that it may be linked with.  The
    centre of a token is that of its classes whose prefix is most common (the
    original of a family of edited copies, as a rule); a class takes the centre
    that it meets on most tokens."""
    centres = shared.groupBy("token").agg(F.max(F.struct("hub", F.col("class").alias("b"), F.col("n").alias("n_b"), F.col("rank").alias("rank_b"))).alias("best")).select("token", "best.*")
    members = shared.select("token", F.col("class").alias("a"), F.col("n").alias("n_a"), F.col("rank").alias("rank_a"))
    met = members.join(centres, "token").where((F.col("a") != F.col("b")) & may_link(percent))
    best = met.groupBy("a", "b").agg(F.count("*").alias("common")).groupBy("a").agg(F.max(F.struct("common", "b")).alias("m"))
    return best.select("a", F.col("m.b").alias("b"))


def crossing_pairs(shared: DataFrame, components: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """(a, b) of different components that may be linked.

    Linked sets have ``least_common`` tokens or more in common in their
    prefixes.  The rarest of those has, in both sets, at least that many prefix
    tokens from it upwards in the order by frequency: so a pair meets on tokens
    of that rank only, and a passage that many documents share, being frequent,
    does not bring them together.  Jaccard distance is a metric: of two classes
    with one centre (``centres``: class, centre, distance) whose distances from
    it differ by more than a link's, none is linked to the other."""
    rows = shared.select("token", "class", "n", "rank").join(components, "class", "left").withColumn("root", F.coalesce("root", "class"))
    ends = rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
    mixed = staged(rows.join(ends, "token").join(centres, "class", "left"), "jaccard-mixed")
    x, y = (mixed.select("token", *[F.col(c).alias(f"{c}_{e}") for c in ("class", "n", "rank", "root", "centre", "distance")]) for e in "ab")
    apart = (F.col("centre_a") == F.col("centre_b")) & (F.abs(F.col("distance_a") - F.col("distance_b")) > F.lit(1 - percent / 100 + 1e-9))
    fits = (F.col("root_a") < F.col("root_b")) & may_link(percent) & ~F.coalesce(apart, F.lit(False))
    return x.join(y, "token").where(fits).select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()


def grouped(docs: DataFrame, size: int, percent: int, key: str, text: str) -> DataFrame:
    """(doc_id, row, n, root) of every document: those that links reach from
    each other have one root, null for the empty set."""
    # nothing here has a proven size but the bitmaps, which are broadcast by name:
    # no other side is, so that the plan is the same at every size
    never = settings(docs.sparkSession, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    with never, arrow_rows(docs.sparkSession, ROWS_AT_ONCE):
        return _grouped(docs, size, percent, key, text)


def _grouped(docs: DataFrame, size: int, percent: int, key: str, text: str) -> DataFrame:
    texts = docs.select(F.col(key).alias("doc_id"), ascii_lower(F.col(text)).alias("text"), row_key(key, text).alias("row"))
    sketch = frequency_sketch(texts.select("text"), size)
    found = staged(document_classes(texts, size, percent, sketch), "jaccard-documents")
    # one document stands for its class
    classes = staged(found.where("class is not null").groupBy("class").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.count("first").alias("carriers")), "jaccard-classes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        return class_sets(texts, wanted, size, percent, sketch)

    shared = shared_tokens(found, classes)
    stars = confirmed(star_pairs(shared, percent), classes, sets_of, percent, "jaccard-star", all_orders=False)
    components = connected_components(stars.where("linked"))
    centres = stars.select(F.col("a").alias("class"), F.col("b").alias("centre"), "distance")
    more = confirmed(crossing_pairs(shared, components, centres, percent), classes, sets_of, percent, "jaccard-cross").where("linked").select("a", "b")
    # what the further links join are whole components
    root = components.select(F.col("class").alias("member"), "root")
    for end in "ab":
        more = more.join(root, F.col(end) == F.col("member"), "left").withColumn(end, F.coalesce("root", end)).select("a", "b")
    joined = connected_components(more).withColumnRenamed("root", "top")
    components = components.unionByName(joined.select("class", F.col("top").alias("root")).join(components, "class", "left_anti"))
    components = components.join(joined.select(F.col("class").alias("root"), "top"), "root", "left").select("class", F.coalesce("top", "root").alias("root"))

    return found.select("doc_id", "row", "n", "class").join(components, "class", "left").select("doc_id", "row", "n", F.coalesce("root", "class").alias("root"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: key, ``n_shingles`` and ``component_id``, the
    smallest id that links reach from it."""
    rooted = grouped(docs, size, percent, key, text).drop("row")
    least = rooted.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(least, "root", "left").select(
        F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group, that of the smallest id (of
    several texts of that id one); of equal rows (id and text) one stays.  Other
    texts of an id are documents of their own.  Rows without id all stay.  Only
    texts that may go or repeat are shuffled."""
    rooted = staged(grouped(docs, size, percent, key, text).where("doc_id is not null"), "jaccard-groups")
    row, of, stays = fresh(docs, "row", "of", "stays")
    first = rooted.where("root is not null").groupBy("root").agg(F.min(F.struct("doc_id", "row")).alias("first")).select("root", F.col("first.row").alias("first"))
    judged = rooted.join(first, "root", "left").select("row", (F.col("root").isNull() | (F.col("row") == F.col("first"))).cast("int").alias("stays"))
    rows = judged.groupBy("row").agg(F.count("*").alias("n"), F.max("stays").alias("stays"))
    odd = staged(rows.where("n > 1 or stays = 0").select(F.col("row").alias(of), F.col("stays").alias(stays)), "jaccard-odd")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.withColumn(row, row_key(key, text))
    may_go, = fresh(keyed, "may_go")
    keyed = flagged(keyed, F.col(row), id_bitmap(odd, of), may_go)
    goes = F.col(key).isNotNull() & F.col(may_go)
    plain = keyed.where(~goes)
    rest = keyed.where(goes).join(odd, F.col(row) == F.col(of), "left")
    alone = rest.where(F.col(of).isNull())
    kept = rest.where(F.col(stays) == 1).dropDuplicates([row])
    return plain.select(*columns).unionByName(alone.select(*columns)).unionByName(kept.select(*columns))
