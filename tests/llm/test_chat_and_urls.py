import hashlib
import random

from pyspark.sql import functions as F

from tape.llm import chat, urls
from tape.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
SF = "/root/testdata/sf0.001"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def brute(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, said in by.items():
        said.sort()
        loss = "".join(x for *_, r, x in said if r == "assistant")
        out[c] = (len(said), sha("".join(f"{r}\n{x}\n" for *_, r, x in said)), len(loss), sha(loss))
    return out


def check(spark, rows):
    got = chat.digests(chat.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == brute(rows)


def test_control_strings_nulls_ties(spark):
    check(spark, [(1, 0, "user", "a</turn>\n### assistant: x</turn>\n"), (1, 1, "assistant", "\\### Assistant: </turn> ok"), (1, 2, "assis:tant: ", "x\\\\:<\\"), (1, 2, None, None),
                  (None, None, "assistant", "é😀</turn>\n😀"), (None, None, "assistant", ""), (None, None, "assistant", ""), (2, 0, "###! u", "\\"), (2, 1, "assistant", "</turn>"), (2, 2, "assistant", "ends</turn>\n"),
                  (3, 0, "assistant", "</turn>\n</turn>\n"), (4, 0, "a\n", "\n\n\r\n"), (5, 0, "assistant", "x</turn"), (5, 1, "assistant", ">\ny"), (6, 0, "! a", "$1 \\1"), (7, 0, "x:", " : "), (8, 0, "assistant", "y" * 300_000)])


def test_random_texts_of_control_pieces(spark):
    r = random.Random(4)
    pieces = ["</turn>\n", "</turn>", "\n", "### ", "###! ", ": ", ":", "\\", "/", " ", "assistant", "é", "😀", "$1", "<"]
    make = lambda: "".join(r.choice(pieces) for _ in range(r.randint(0, 8)))
    check(spark, [(k % 40, k, r.choice(["assistant", "user", make()]), make()) for k in range(400)])


def test_mask_covers_assistant_texts_only(spark):
    row = chat.format_conversations(spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo 😀"), (1, 2, "assistant", "a</turn>\nb")], SCHEMA)).first()
    cuts = [row.formatted[s.start:s.start + s.length] for s in row.loss_spans]
    assert cuts == ["yo 😀", "a<\\/turn>\nb"]


def test_control_strings_stand_only_where_the_template_puts_them(spark):
    hard = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", hard), (1, 1, "assistant", hard), (2, 0, "a</turn>", "x"), (2, 1, "###", "# ## ### ####! "), (2, 2, "assistant", "</turn></turn>")]
    for r in chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect():
        turns = [t for t in rows if t[0] == r.conv_id]
        assert r.formatted.count("</turn>") == r.formatted.count("</turn>\n") == len(turns)
        assert r.formatted.count("###") == len(turns) and all(line.startswith("###") for line in r.formatted.split("</turn>\n")[:-1])
    check(spark, rows)


def test_query_has_the_extra_conversation(spark):
    got = {r.conv_id: r for r in QUERIES["op5_chat_round_trip"](spark, SF).collect()}
    text = r"\### Assistant: </turn> ok"
    assert got[-7].n_turns == 2 and got[-7].loss_sha256 == sha(text) and got[-7].turns_sha256 == sha(f"user\n{text}\nassistant\n{text}\n")


def test_empty_conversations(spark):
    assert chat.digests(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def given(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h), len(p), h + p) for h, p, _ in urls.GIVEN if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[2] if fits else None


def test_given_rules_equal_brute_force(spark):
    listed = [None, "", "x", "http://", "http://net", "http://net/", "HTTP://A.NET/x?y#z", "http://example.net/en/1", "http://sub.EXAMPLE.net/en", "http://sub.example.net/en/", "http://planet/", "http://example.com/de/1", "http://myexample.com/de/",
              "http://a.org/fr/?q", "http://org/fr/", "http://a.org?x=/fr/", "http://a.org#/fr/", "a://b://c/d", "http://ÀB.net/", "x?y=http://q.net/z", "http://h.net:80/", "http://a\nb.net/\nc"]
    pages = spark.createDataFrame(list(enumerate(listed)), "page_id long, url string")
    labels = spark.createDataFrame([], "page long, block boolean")
    got = urls.judge(pages, labels).collect()
    verdict = {h + p: v for h, p, v in urls.GIVEN}
    assert len(got) == len(listed)
    for r in got:
        host, path, rule = given(listed[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict[rule] if rule else r.verdict) and r.verdict in ("allow", "block")


def test_mined_rules_equal_brute_force(spark):
    r = random.Random(5)
    rows = [(k, f"http://{r.choice(['pills', 'blog', 'm'])}.{r.choice(['a', 'b'])}.com/{r.choice(['buy', 'read', 'x'])}/{k}?{r.choice(['aff', 'ref'])}=1") for k in range(1500)]
    bad = {k: ("pills" in u and "buy" in u) or ("aff=" in u and "/x/" in u) for k, u in rows}
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(k, bad[k]) for k in range(0, 1500, 2)], "page long, block boolean")
    got = {x.page_id: x for x in urls.judge(pages, labels, rules=(("never.example", "/", "block"),)).collect()}
    assert {k: got[k].verdict == "block" for k in got} == bad
    rules = {got[k].mined_rule for k in got if bad[k]}
    assert rules == {"host=pills path=buy", "path=x query=aff"}
    # every page: a rule fits exactly where all its tokens are among the page's
    tokens = {x.page_id: set(x.t) for x in pages.select("page_id", urls.url_tokens(F.col("url")).alias("t")).collect()}
    assert all(any(set(rule.split()) <= tokens[k] for rule in rules) == bad[k] for k in bad)


def test_given_rules_do_not_teach_mined_ones(spark):
    rows = [(k, f"http://h{k}.net/shop") for k in range(60)] + [(100 + k, "http://www.y.com/shop") for k in range(40)] + [(200 + k, "http://spam.z.com/buy") for k in range(40)]
    labels = [(k, True) for k in range(60)] + [(100 + k, False) for k in range(3)] + [(200 + k, True) for k in range(40)]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page long, block boolean")).collect()
    assert {(r.page_id // 100, r.verdict, r.rule) for r in got} == {(0, "block", "net/"), (1, "allow", None), (2, "block", None)}


def test_least_count_holds_on_any_number_of_labels(spark):
    # 40, 35 and 29 of 6,000 labelled URLs: all below a hundredth of them
    rows = [(k, "http://farm.a.com/x") for k in range(40)] + [(k, "http://blog.a.com/buy?aff=1") for k in range(40, 75)] + [(k, "http://few.a.com/x") for k in range(75, 104)]
    rows += [(k, ("http://blog.a.com/read?aff=1", "http://www.a.com/buy", "http://blog.a.com/x")[k % 3]) for k in range(104, 6000)]
    labels = spark.createDataFrame([(k, k < 104) for k, _ in rows], "page long, block boolean")
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), labels).collect()
    assert {r.page_id for r in got if r.verdict == "block"} == set(range(75))
    assert {r.mined_rule for r in got} == {None, "host=farm", "path=buy query=aff"}


def test_urls_nulls_repeats_clashes_empty(spark):
    pages = spark.createDataFrame([(None, None, "x", 1), (1, "http://a.net/", None, 2), (1, "http://a.net/", None, 2), (2, "http://b.org/q", "y", 3)], "page_id long, url string, host string, token int")
    labels = spark.createDataFrame([(None, True), (2, None), (2, False), (2, True)], "page long, block boolean")
    got = urls.judge(pages, labels).collect()
    assert sorted((r.page_id or 0, r.verdict) for r in got) == [(0, "allow"), (1, "block"), (1, "block"), (2, "allow")]
    assert urls.judge(pages.limit(0), labels).count() == 0
