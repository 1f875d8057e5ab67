"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged into one tree: element nodes with the same
chain of labels (tag, class, id; digits masked) are one node.  For every node
of the tree Spark counts, over all pages of the host, in how many pages it
occurs (m), its presentation styles (sequences of child labels) and its contents
(texts of its own).  Node importance is entropy to the base m:

* presentation: ``-sum(p_i log_m p_i)`` over the shares of its styles - a
  template always looks the same and has none;
* content: ``1 - mean(H(a_i))`` over its texts, ``H(a) = log_m k`` for a text on
  k pages - a text on every page says nothing about one.

Composite importance is ``(1 - g^l) * presentation + g^l * mean(children)`` with
l styles and g = 0.9.  A branch whose nodes are all below the threshold is
removed from each page.  Elements whose tag, class or role states what they are
have a prior: menus, headers, footers, sidebars, notices, adverts, forms, media
and reader comments have importance 0, article and main importance 1: whatever is inside
them is never removed by entropy.

What pruning leaves is the text: blocks outside article and main stay where the
tree finds them important.  A page that no tree can judge (without host, or of a
host that has no node on ``MIN_PAGES`` pages) gives the text inside article or
main, of the body if there is none.  Character references are decoded, white
space inside a block becomes one space, and blocks are joined by line feeds.

Defined cases: null and empty html give the empty text; nodes on fewer than
``MIN_PAGES`` pages are never removed by entropy; a page that pruning by entropy
would leave empty keeps its text; unclosed tags, stray end tags and cut-off pages
are read as they come; a very long page is read whole, as one row; repeated rows
stay rows, and count as pages of the tree; ties do not occur; an empty table
gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from html import unescape

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import staged
from .urls import host_of

#: Nodes below this composite importance are noise; pages a node must be on;
#: damping of the children's importance.
THRESHOLD, MIN_PAGES, DAMPING = 0.2, 8, 0.9

#: Elements by what they are.
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing main menu nav ol optgroup option p pre search section select summary table
tbody tfoot thead tr ul""".split())
NOISE_TAGS = frozenset("head nav footer aside form button select dialog menu search object audio video canvas svg math datalist fieldset".split())
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu footer
sidebar aside cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments
disqus replies respond breadcrumb breadcrumbs pagination pager related recommended recommendations share sharing social toolbar widget skip""".split())
WEAK_NOISE_WORDS = frozenset("header masthead banner topbar search tags".split())
CONTENT_WORDS = frozenset("article post entry content main story body text".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
CONTENT_TAGS = frozenset("article main".split())
#: An opening tag of the key closes an open element of the value.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "option": ("option",), "tbody": ("tr", "thead", "tbody"), "tfoot": ("tr", "tbody")}

TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
ATTRIBUTE = re.compile(r"""([^\s"'=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TELLING = frozenset(("class", "id", "role", "hidden", "aria-hidden", "style"))
RAW_END = {t: re.compile(rf"</{t}\b[^>]*>?", re.I) for t in RAW}


def role_of(tag: str, attributes: dict, in_content: bool) -> int:
    """-1 for an element that its name states to be no main text, 1 for the
    main text, else 0."""
    if tag in NOISE_TAGS or (tag == "header" and not in_content):
        return -1
    if not attributes:
        return 1 if tag in CONTENT_TAGS else 0
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attributes.get("style", ""), re.I):
        return -1
    role = attributes.get("role", "").lower()
    if role in NOISE_ROLES:
        return -1
    words = set(re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{attributes.get('class', '')} {attributes.get('id', '')}").lower()))
    if tag not in ("html", "body"):
        if words & NOISE_WORDS:
            return -1
        if not in_content and words & WEAK_NOISE_WORDS and not words & CONTENT_WORDS:
            return -1
    return 1 if tag in CONTENT_TAGS or role in ("main", "article") else 0


def _hash(parent: int, label: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{parent}>{label}".encode(errors="surrogatepass"), digest_size=8).digest(), "little", signed=True)


class Page:
    """Blocks of one page: (chain of node hashes, inside article or main, text),
    and the styles of its nodes.  ``names`` caches hashes of labels."""

    def __init__(self, html: str, names: dict):
        self.blocks: list[tuple[tuple, bool, str]] = []
        self.children: dict[int, list[str]] = {}
        self.parent: dict[int, int] = {}
        self.names = names
        # open elements: (tag, node, role noise inside, inside content)
        self.open: list[tuple[str, int, bool, bool]] = []
        self.text: list[str] = []
        self.read(html)
        self.flush()

    def node(self, parent: int, label: str) -> int:
        key = (parent, label)
        if key not in self.names:
            if len(self.names) > 200_000:
                self.names.clear()
            self.names[key] = _hash(parent, label)
        return self.names[key]

    def flush(self) -> None:
        if self.text:
            if not (self.open and self.open[-1][2]):
                words = "".join(self.text).split()
                if words:
                    self.blocks.append((tuple(e[1] for e in self.open), bool(self.open) and self.open[-1][3], " ".join(words)))
            self.text = []

    def close(self, at: int) -> None:
        self.flush()
        del self.open[at:]

    def last_open(self, tags, stop=()) -> int:
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] in tags:
                return k
            if self.open[k][0] in stop:
                return -1
        return -1

    def start(self, tag: str, attributes: dict) -> None:
        inside = bool(self.open) and self.open[-1][3]
        role = role_of(tag, attributes, inside)
        if tag not in BLOCK and role >= 0:
            if tag in ("br", "td", "th"):
                self.text.append(" ")
            return
        if tag in BLOCK:
            at = self.last_open(("p",), ("article", "main", "div", "section", "td", "li", "blockquote"))
            if at >= 0:
                self.close(at)
            at = self.last_open(CLOSES.get(tag, ()), ("ul", "ol", "dl", "table"))
            if at >= 0:
                self.close(at)
        self.flush()
        if tag in VOID:
            return
        label = tag
        if attributes:
            label += re.sub(r"\d+", "0", "".join(f"[{a}={attributes[a].strip().lower()}]" for a in ("class", "id") if attributes.get(a)))
        above = self.open[-1] if self.open else ("", 0, False, False)
        node = self.node(above[1], label)
        self.children.setdefault(above[1], []).append(label)
        self.children.setdefault(node, [])
        self.parent[node] = above[1]
        self.open.append((tag, node, above[2] or role < 0, above[3] or role > 0))

    def read(self, html: str) -> None:
        at, n, tag_at = 0, len(html), TAG
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self.text.append(unescape(html[at:]))
                return
            if lt > at:
                part = html[at:lt]
                self.text.append(unescape(part) if "&" in part else part)
            after = html[lt + 1:lt + 2]
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                at = n if end < 0 else end + 3
            elif after in ("!", "?"):
                end = html.find(">", lt)
                at = n if end < 0 else end + 1
            elif after.isalpha() or (after == "/" and html[lt + 2:lt + 3].isalpha()):
                m = tag_at.match(html, lt)
                if m is None:
                    tag_at = LOOSE_TAG  # an unclosed quote: end tags at the first bracket from here on
                    m = tag_at.match(html, lt)
                if m is None:
                    return  # cut off inside a tag
                at, tag = m.end(), m[2].lower()
                if m[1]:
                    k = self.last_open((tag,))
                    if k >= 0:
                        self.close(k)
                    elif tag in BLOCK:
                        self.flush()
                elif tag in RAW:
                    end = RAW_END[tag].search(html, at)
                    at = n if end is None else end.end()
                else:
                    attributes = {}
                    if m[3]:
                        for a, v in ATTRIBUTE.findall(m[3]):
                            if a.lower() in TELLING:
                                attributes[a.lower()] = v.strip("\"'")
                    self.start(tag, attributes)
            else:
                self.text.append("<")
                at = lt + 1

    def main_text(self, noise: frozenset | None) -> str:
        """What is left without the nodes in ``noise``; None where no tree has
        judged the page: then, if there is an article or main, what is in it."""
        kept = self.blocks
        if noise is None:
            kept = [b for b in kept if b[1]] or kept
        else:
            # article and main have importance 1, whatever the entropy of what is in them
            kept = [b for b in kept if b[1] or not noise.intersection(b[0])] or kept
        return "\n".join(b[2] for b in kept)


def _digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(errors="surrogatepass"), digest_size=8).digest(), "little", signed=True)


def style_tree(pages: DataFrame) -> DataFrame:
    """(host, node, parent, m, presentation, styles, texts, content): the merged
    nodes of each host with their entropies, from (host, html)."""
    def rows(batches):
        found: Counter = Counter()
        names: dict = {}

        def flush():
            if found:
                keys = list(found)
                yield pa.RecordBatch.from_arrays([pa.array([k[c] for k in keys], t) for c, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()))] + [pa.array(list(found.values()), pa.int64())], names=["host", "node", "parent", "kind", "feature", "k"])
                found.clear()

        for batch in batches:
            for host, html in zip(batch.column("host"), batch.column("html")):
                page, host = Page(html.as_py(), names), host.as_py()
                for node, above in page.parent.items():
                    found[host, node, above, "style", _digest(" ".join(page.children[node]))] += 1
                for node, text in {(b[0][-1], b[2]) for b in page.blocks if b[0]}:
                    found[host, node, page.parent[node], "text", _digest(text)] += 1
                if len(found) > 100_000:
                    yield from flush()
        yield from flush()

    counts = pages.mapInArrow(rows, "host string, node long, parent long, kind string, feature long, k long").groupBy("host", "node", "parent", "kind", "feature").agg(F.sum("k").alias("k"))
    style, text = F.col("kind") == "style", F.col("kind") == "text"
    nodes = counts.groupBy("host", "node", "parent").agg(
        F.sum(F.when(style, F.col("k"))).alias("m"), F.sum(F.when(style, F.col("k") * F.log("k"))).alias("klogk"), F.count(F.when(style, 1)).alias("styles"),
        F.count(F.when(text, 1)).alias("texts"), F.sum(F.when(text, F.log("k"))).alias("logk"))
    base = F.log("m")
    return nodes.select("host", "node", "parent", "m", "styles", "texts",
                        F.when(F.col("m") > 1, (base - F.col("klogk") / F.col("m")) / base).otherwise(1.0).alias("presentation"),
                        F.when((F.col("m") > 1) & (F.col("texts") > 0), 1 - F.least(F.lit(1.0), F.col("logk") / F.col("texts") / base)).otherwise(1.0).alias("content"))


def noise_nodes(tree: DataFrame, threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, noise): the nodes whose whole branch is of low importance, an empty
    list where there is none.  A task gets the nodes of one host that are on
    ``min_pages`` pages or more; rarer ones count as important children only."""
    seldom = tree.where(F.col("m") < min_pages).groupBy(F.col("host").alias("h"), F.col("parent").alias("p")).agg(F.count("*").alias("seldom"))
    known = tree.where(F.col("m") >= min_pages).join(seldom, (F.col("host") == F.col("h")) & (F.col("node") == F.col("p")), "left").drop("h", "p").fillna(0, ["seldom"])

    def judge(nodes: pd.DataFrame) -> pd.DataFrame:
        rows = {r.node: r for r in nodes.itertuples()}
        below: dict = {}
        for r in rows.values():
            below.setdefault(r.parent, []).append(r.node)
        composite: dict = {}
        highest: dict = {}
        todo = [(n, False) for n in rows if rows[n].parent not in rows]
        while todo:
            node, ready = todo.pop()
            inner = below.get(node, [])
            if not ready:
                todo.append((node, True))
                todo += [(c, False) for c in inner]
                continue
            r = rows[node]
            parts = [composite[c] for c in inner] + [1.0] * (r.seldom > 0) + [r.content] * (r.texts > 0)
            if inner or r.seldom:
                damp = DAMPING ** r.styles
                composite[node] = (1 - damp) * r.presentation + damp * (sum(parts) / len(parts))
            else:
                composite[node] = r.content if r.texts else r.presentation
            highest[node] = max([composite[node], *[highest[c] for c in inner], *([1.0] * (r.seldom > 0))])
        noise = sorted(n for n, v in highest.items() if v < threshold)
        return pd.DataFrame({"host": [nodes.host.iloc[0]], "noise": [noise]})

    return known.select("host", "node", "parent", "styles", "texts", "presentation", "content", "seldom").groupBy("host").applyInPandas(judge, "host string, noise array<long>")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """key, url, text and n_chars of every page."""
    named = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"), host_of(F.col(url)).alias("host"))
    tree = staged(style_tree(named.where((F.col("host") != "") & F.col("html").isNotNull()).select("host", "html")), "html-tree")
    noise = staged(noise_nodes(tree, threshold, min_pages), "html-noise")
    joined = named.join(noise.withColumnRenamed("host", "of"), F.col("host") == F.col("of"), "left").select("key", "url", "html", "noise")
    schema = StructType([StructField("key", joined.schema["key"].dataType), StructField("url", StringType()), StructField("text", StringType())])

    def rows(batches):
        names: dict = {}
        for batch in batches:
            out = []
            for page, noise in zip(batch.column("html"), batch.column("noise")):
                judged = frozenset(noise.as_py()) if noise.is_valid else None
                out.append(Page(page.as_py(), names).main_text(judged) if page.is_valid else "")
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), pa.array(out, pa.string())], names=["key", "url", "text"])

    return joined.mapInArrow(rows, schema).select(F.col("key").alias(key), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))
