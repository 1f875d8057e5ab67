import itertools
import random
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from tape.llm import negatives, phrases, tokens

FILE = public_tokenizers.path("byte_bpe_50k.json")

# ---------------------------------------------------------------- token counts


def library(texts):
    found = tokens.load(open(FILE).read())
    return [len(found.encode(t or "", add_special_tokens=False).ids) for t in texts]


ODD = [
    None, "", " ", "\n\n \t", "don't we'll I'VE", "a  b   c\n\n d ", "x" * 5000, "naïve café – 東京 тест ١٢٣ 🙂 ½", "<|endoftext|>", "a<|endoftext|> b <|endoftext|",
    "new ՘ \U0003fc3d letter", "\x00\x1c\x1f\x85  x", "word " * 300, "word " * 300, "'s 't ' re", "tab\tand\r\nline", "é ‍ �",
]


def test_tokens_equal_the_library(spark):
    rows = [(i if i % 3 else None, t, "x", 9) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, piece int").repartition(3)
    got = tokens.token_counts(docs, FILE, limit=100).collect()
    want = Counter((i if i % 3 else None, len((t or "").encode()), n, n > 100) for (i, t), n in zip(enumerate(ODD), library(ODD)))
    assert Counter(tuple(r) for r in got) == want


def test_tokens_of_an_empty_table(spark):
    got = tokens.token_counts(spark.createDataFrame([], "doc_id long, text string"), FILE)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and got.count() == 0


def test_tokens_of_the_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(docs, FILE).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert got == dict(zip([r[0] for r in rows], library([r[1] for r in rows])))


def test_cutting_agrees_with_the_library_on_every_sure_character():
    from tokenizers import pre_tokenizers
    cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    checked = 0
    for block in range(0, 0x110000, 64):
        chars = [chr(c) for c in range(block, block + 64) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1!{c}\n" for c in chars if tokens.is_sure(c))
        checked += len(text) // 6
        assert [s for _, s in cut.pre_tokenize_str(text)] == [m.span() for m in tokens.PIECES.finditer(text)]
    assert checked > 200_000


def test_plain_pattern_equals_the_other_on_ascii():
    for pair in itertools.product(map(chr, range(128)), repeat=2):
        text = "a" + "".join(pair) + " 1" + pair[0]
        assert tokens.PLAIN_PIECES.findall(text) == tokens.PIECES.findall(text)


def test_slices_and_full_cache_change_nothing(monkeypatch):
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", "B ", " c", "  ", "\n", "é", "1", "'s", ". ", "word "]) for _ in range(900)) for _ in range(40)]
    monkeypatch.setattr(tokens, "CACHE_SIZE", 7)
    found = tokens.load(open(FILE).read())
    monkeypatch.setattr(tokens, "SLICE", 20)
    lengths = tokens.Lengths(found, {})
    for t in texts:
        cut = list(tokens.slices(t, 20))
        assert "".join(cut) == t and [p for c in cut for p in tokens.pieces(c)] == tokens.pieces(t)
    assert [lengths.count(t) for t in texts] == library(texts) and len(lengths) <= 7


def test_a_text_of_millions_of_words_is_counted_in_slices():
    text = "some words, again " * 400_000
    lengths = tokens.Lengths(tokens.load(open(FILE).read()), {})
    one, two, four = (lengths.whole("some words, again " * n) for n in (1, 2, 4))
    assert two - one == (four - two) // 2
    assert lengths.count(text) == one + (two - one) * 399_999 and len(list(tokens.slices(text))) > 5


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        tokens.check_kind('{"pre_tokenizer": {"type": "Whitespace"}}')


# ---------------------------------------------------------------- collocations


def phrase_brute(rows, least=10, top=2000):
    counts, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = regex.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in regex.split(r"[.,;:!?\x0A-\x0D]", low):
            w = regex.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in (1, 2, 3):
                counts.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in cand.items():
        if any(q[0] == lang and len(q[1]) > len(p) and 100 * b >= 50 * a and any(q[1][i:i + len(p)] == p for i in range(len(q[1]) - len(p) + 1)) for q, b in cand.items() if len(q[1]) > len(p)):
            continue
        score, k = min((1000000 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], total[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    rank, got = Counter(), []
    for lang, p, a, l, r, n, score in out:
        rank[lang] += 1
        if rank[lang] <= top:
            got.append((lang, rank[lang], p, a, l, r, n, score))
    return got


def phrase_rows():
    rng = random.Random(3)
    vocabulary = ["new", "York", "city", "the", "é", "of", "a'b", "x1", "Öl", "z"]
    rows = []
    for i in range(160):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "!?"]) for _ in range(rng.randrange(60)))
        rows.append((rng.choice(["en", "de", None, "und"]), text))
    return rows + [("en", None), (None, ""), ("en", "..."), ("fr", "new york " * 40), ("fr", "new york " * 40), ("xx", "one")]


@pytest.mark.parametrize("words, bytes_", [(1 << 20, 1 << 20), (50, 40), (7, 5)])
def test_phrases_equal_brute_force(spark, monkeypatch, words, bytes_):
    rows = phrase_rows()
    docs = spark.createDataFrame([(None, a, b, 1) for a, b in rows], "doc_id long, lang string, text string, f int").repartition(3)
    # small shards cut texts, pieces and phrases everywhere
    emitted = cut_shards(words, bytes_)
    monkeypatch.setattr(phrases, "counted", emitted)
    got = phrases.collocations(docs, least=10, top=25).collect()
    assert sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in got) == sorted(phrase_brute(rows, 10, 25))


def cut_shards(words, bytes_):
    """``phrases.counted`` with other constants in its tasks."""
    whole = phrases.counted

    def counted(docs, emit):
        def tuned(lang, names, index, carried):
            yield from emit(lang, names, index, carried)
        return whole(docs, tuned, shard_words=words, slice_bytes=bytes_)

    return counted


def test_intervals_extend_in_both_directions():
    rng = np.random.default_rng(1)
    ids = np.concatenate([[0], rng.integers(0, 6, 500), [0]])
    ids = ids[np.concatenate([[True], (ids[1:] != 0) | (ids[:-1] != 0)])]
    index = phrases.Index(ids)
    grams = [Counter(tuple(ids[i:i + k]) for i in range(len(ids) - k + 1)) for k in (1, 2, 3)]
    grams = [{g: n for g, n in c.items() if 0 not in g} for c in grams]
    x, y, left, right, n = index.pairs(onward=True)
    assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == grams[1]
    every = np.ones(len(x), bool)
    a, b, c, f = index.triples((x, y, left, right, n), every)
    assert dict(zip(zip(a.tolist(), b.tolist(), c.tolist()), f.tolist())) == grams[2]
    # a pair's right extensions from its other interval give the same triples
    own, sym, _, _, f = index.extend(index.forward, right, left, n)
    assert dict(zip(zip(x[own].tolist(), y[own].tolist(), sym.tolist()), f.tolist())) == grams[2]
    # pairs by the left give the same intervals
    w, wl, wr, wn = index.words()
    own, sym, left2, right2, f = index.extend(index.backward, wl, wr, wn, onward=True)
    assert {(s, w[o]): (p, q, k) for o, s, p, q, k in zip(own, sym, left2, right2, f)} == {(i, j): (p, q, k) for i, j, p, q, k in zip(x, y, left, right, n)}


def test_pair_places_are_the_same_in_both_engines(spark):
    words = [b"a", "é".encode(), b"long-word-of-many-letters", b"#"]
    rows = [("en", f"{a.decode()} {b.decode()}", i, j) for i, a in enumerate(words) for j, b in enumerate(words)]
    got = spark.createDataFrame(rows, "lang string, phrase string, i int, j int").select("i", "j", phrases.pair_slot().alias("slot")).collect()
    want = phrases.slots_of("en", words, np.array([r.i for r in got]), np.array([r.j for r in got]))
    assert [r.slot for r in got] == want.tolist() and len(set(want.tolist())) == 16


def test_phrases_of_an_empty_table_and_of_a_very_long_text(spark):
    empty = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert phrases.collocations(empty).count() == 0
    text = "to be or not " * 300_000 + "x" * 100_000
    got = phrases.collocations(spark.createDataFrame([("en", text)], "lang string, text string"), 10, 5).collect()
    assert {(r["phrase"], r["a"], r["n"]) for r in got} == {("to be or", 300_000, 1_200_001), ("be or not", 300_000, 1_200_001), ("or not to", 299_999, 1_200_001), ("not to be", 299_999, 1_200_001)}


def test_scores_pass_64_bits(spark):
    n = 9_000_000_000_000
    rows = [("en", "", 0, 3 * n), ("en", "p", 1, n), ("en", "q", 1, n + 7), ("en", "p q", 2, n - 5)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, words int, f long")
    assert phrases.scored(counts).first()["score"] == 1000000 * (n - 5) ** 2 // (n * (n + 7))


# -------------------------------------------------------------- hard negatives


def negatives_brute(rows, every=50, positives=5, negatives_=3, low=50, high=95, grain=256):
    good = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(c is None or not np.isfinite(c) for c in v):
            continue
        good.append((i, label, [int(np.floor(grain * float(c))) for c in v]))
    out = []
    for i, label, v in {(i, l, tuple(v)) for i, l, v in good if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in good if j != i)
        for score, j, m in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and -low * score <= -100 * s[0] <= -high * score]
            out += [(i, j, k + 1, s[1], -score, -s[0]) for k, s in enumerate(fits[:negatives_])]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 6))
    rows = [(int(i), int(rng.integers(0, 4)), [float(x) for x in centres[i % 4] + 0.3 * rng.normal(size=6)]) for i in range(400)]
    same = [0.5, 0.25, 0.125, 0.5, 0.5, 0.75]
    rows += [(1000 + i, i % 3, same) for i in range(150)]  # a hot vector: ties
    rows += [(2000, 1, same), (2000, 1, same), (2001, 2, same), (2001, 2, same), (2050, 1, [0.5])]
    rows += [(None, 1, same), (2100, None, same), (2150, 1, None), (2200, 1, [float("nan")] * 6), (2250, 1, [None] + same[1:]), (2300, 1, [float("inf")] * 6), (2350, 2, []), (-50, 2, same)]
    data = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, label int, embedding array<double>, score int, branch string").repartition(4)
    want = negatives_brute(rows)
    assert len(want) > 50
    for cell_rows, cell_anchors in ((1 << 15, 1 << 15), (40, 5)):
        monkeypatch.setattr(negatives, "CELL_ROWS", cell_rows)
        monkeypatch.setattr(negatives, "CELL_ANCHORS", cell_anchors)
        assert sorted(tuple(r) for r in negatives.hard_negatives(data).collect()) == want


def test_hard_negatives_without_rows(spark):
    schema = "vec_id long, label int, embedding array<float>"
    assert negatives.hard_negatives(spark.createDataFrame([], schema)).count() == 0
    alone = spark.createDataFrame([(0, 1, [1.0]), (1, 2, [1.0])], schema)
    assert negatives.hard_negatives(alone).count() == 0


def test_large_components_stay_exact(spark):
    big = 2.0 ** 21
    rows = [(0, 1, [big, 1.0]), (1, 1, [big, 3.0]), (2, 2, [big * 0.9, 5.0]), (3, 2, [big * 0.9, 5.00390625]), (4, 2, [big * 0.94, 0.0])]
    data = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert sorted(tuple(r) for r in negatives.hard_negatives(data).collect()) == negatives_brute(rows)


def test_subtrees_are_eliminated_by_their_ranges(spark):
    rng = np.random.default_rng(9)
    x = np.vstack([np.round(100 * c + rng.normal(size=(50, 3))) for c in np.eye(3)]).astype(np.int64)
    rows = spark.createDataFrame([(i, 0, [int(v) for v in r]) for i, r in enumerate(x)], "id long, label long, x array<bigint>")
    tree, bound, _ = negatives.grown_tree(rows)
    negatives.learn_ranges(tree, rows)
    q = x[:1]
    scores = (x @ q[0]).astype(float)
    least = np.array([np.sort(scores)[-10]])
    go = tree.reach(-1, q, least, np.array([int(bound) + 1]))[0]
    branch = tree.place(x)[0]
    assert set(branch[scores >= least[0]]) <= set(np.flatnonzero(go)) and go.sum() < len(go)
