"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree: elements with the same path of styles (tag, class
and id without long numbers) are one node. A node is judged by two entropies over the m pages that have
it, equal pages once, both relative to log m: of the different ways its children are arranged (presentation: more is
more important), and of every different text in it over the pages (content: a text that stands on
many pages alike carries little). The importance of a branch blends the two, content averaged over
all texts of the branch.

Branches of low importance are removed from every page. Markup that names itself (navigation,
advert, form, comments, article and the like) is taken at its word first; a host with fewer than
``LEAST_PAGES`` pages has no entropies to speak of and relies on that alone.

Both passes parse where pages are read. The tree is sums over (host, path, text hash), combined in
each batch and before each shuffle, so a host with a third of all pages is no large group. What
returns to the pages is one row per host that lists removed paths; it is a written table, and Spark
broadcasts it if its size allows and else joins by host, splitting skewed hosts.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfold.llm.common import small_batches, whole_text
from ledgerfold.llm.dom import FORM, Node, read_page
from ledgerfold.sources.scratch import written

LEAST_PAGES = 5
LOW = 0.5
DAMPING = 0.9
LINKS_LOW = 0.6

# What element and class names mean by convention.
CHROME_TAGS = frozenset("nav footer aside menu dialog".split()) | FORM
CHROME_NAMES = frozenset("""nav navbar navigation menu menubar breadcrumb breadcrumbs masthead banner footer sidebar widget widgets ad ads advert
    adverts advertisement advertising adsense sponsor sponsored promo promotion cookie cookies consent gdpr notice notices popup modal overlay
    newsletter subscribe signup login share sharing social related recommended recommendations comment comments commentlist disqus reply replies
    respond search pagination pager toolbar copyright legal disclaimer complementary contentinfo teaser teasers alert outbrain taboola""".split())
ARTICLE_CHROME = frozenset("comment comments teaser teasers related promo ad advert sponsored reply".split())
CONTENT_NAMES = frozenset("articlebody article post entry story maincontent content".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption".split())
ROOTS = frozenset(["", "html", "body", "main"])

TREE = "host string, path string, kind int, feature bigint, n double, weighted double, linked double"


def host_of(url_col: str) -> Column:
    """The authority of a URL in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\\\\]*)", 1), F.lit("")))


def is_chrome(node: Node, within: bool) -> bool:
    """The node says of itself that it is not the article; ``within`` a container of the article."""
    if node.tag in ROOTS:
        return False
    if node.tag == "article":
        return bool(node.names & ARTICLE_CHROME)
    if node.tag in CHROME_TAGS:
        return True
    if not within and (node.tag == "header" or "header" in node.names):
        return True
    return bool(node.names & CHROME_NAMES) and not node.names & CONTENT_NAMES


def containers(nodes: list[Node], chrome: list[bool]) -> set[int]:
    """The elements that hold the article: <main>, else <article>, else one named so."""
    for wanted in (lambda n: n.tag == "main" or "main" in n.names and n.tag == "div", lambda n: n.tag == "article",
                   lambda n: n.tag in ("div", "section", "td") and n.names & CONTENT_NAMES):
        found = {i for i, n in enumerate(nodes) if wanted(n) and not chrome[i]}
        if found:
            return found
    return set()


def inherited(nodes: list[Node], own) -> list[bool]:
    """True for nodes where ``own(index)`` is, and for all below."""
    out: list[bool] = []
    for i, node in enumerate(nodes):
        out.append((node.parent >= 0 and out[node.parent]) or own(i))
    return out


def page_features(html: str) -> dict:
    """{(path, kind, feature): (count, linked characters)} of one page. Kinds: 0 the path is there
    (linked: characters of link text, count: all characters), 1 an arrangement of children, 2 a text."""
    nodes, blocks = read_page(html)
    out: Counter = Counter()
    chars: Counter = Counter()
    linked: Counter = Counter()
    for node in nodes[1:]:
        if not node.hidden:
            chars[node.path] += 0
            runs = [t for i, t in enumerate(node.children) if i == 0 or node.children[i - 1] != t]
            if runs:
                out[node.path, 1, zlib.crc32(" ".join(runs).encode()) << 8 | min(len(set(runs)), 255)] += 1
    for at, text, in_links in blocks:
        path = nodes[at].path
        chars[path] += len(text)
        linked[path] += in_links
        out[path, 2, hash_of(text)] += 1
    found = {k: (n, 0) for k, n in out.items()}
    found.update({(p, 0, 0): (c, linked[p]) for p, c in chars.items()})
    return found


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, pages, importance, link_share): every branch of every host's tree. Importance is
    null on fewer than LEAST_PAGES pages and for branches without text."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            sums: dict = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for (path, kind, feature), (n, linked) in page_features(html).items():
                    row = sums.setdefault((host, path, kind, feature), [0.0, 0.0, 0.0])
                    row[0] += 1 if kind == 0 else n
                    row[1] += n if kind == 0 else n * math.log(n)
                    row[2] += linked
            columns = list(zip(*[(*k, *v) for k, v in sums.items()])) or [[] for _ in range(7)]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [c.split()[0] for c in TREE.split(", ")])

    small_batches(pages.sparkSession)
    # Copies on a host (repeated rows, variants of a URL) are one page; tasks drop their own copies before the shuffle.
    slim = pages.select(host_of(url_col).alias("host"), whole_text(html_col).alias("html"))
    different = slim.groupBy("host", F.xxhash64("html").alias("h"), F.length("html").alias("size")).agg(F.first("html").alias("html"))
    raw = different.select("host", "html").mapInArrow(run, TREE)
    keys = ["host", "path"]
    sums = raw.groupBy(*keys, "kind", "feature").agg(F.sum("n").alias("n"), F.sum("weighted").alias("w"), F.sum("linked").alias("l"))

    def of(kind, value):
        return F.sum(F.when(F.col("kind") == kind, value))

    spread = F.log("n") - F.col("w") / F.col("n")  # entropy of one text over the pages, times 1
    nodes = sums.groupBy(*keys).agg(
        of(0, F.col("n")).alias("m"), of(0, F.col("w")).alias("chars"), of(0, F.col("l")).alias("links"),
        of(1, F.col("n")).alias("kids"), of(1, F.col("n") * F.log("n")).alias("kidlog"),
        of(1, F.col("n") * (F.col("feature") % 256)).alias("fan"),
        of(2, F.lit(1.0)).alias("texts"), of(2, spread).alias("spread"))
    scale = F.log(F.greatest("m", F.lit(2.0)))
    nodes = written(nodes.select(
        *keys, "m", "chars", "links", (F.col("fan") / F.col("kids")).alias("fan"),
        ((F.log("kids") - F.col("kidlog") / F.col("kids")) / scale).alias("shape"),
        F.coalesce("texts", F.lit(0.0)).alias("texts"), F.coalesce(F.col("spread") / scale, F.lit(0.0)).alias("alike")), "style-nodes")
    # The branch of a path sums up every path at or below it; "/a/b" lies below "/a".
    parts = F.split(F.substring("path", 2, 1 << 30), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), k), "/")))
    below = nodes.select("host", F.explode(above).alias("path"), "texts", "alike", "chars", "links")
    branches = below.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("texts", "alike", "chars", "links")])
    own = nodes.select(*keys, "m", "fan", "shape")
    content = 1 - F.col("alike") / F.col("texts")
    keep = F.pow(F.lit(DAMPING), F.coalesce("fan", F.lit(0.0)))
    importance = F.when((F.col("m") >= LEAST_PAGES) & (F.col("texts") > 0),
                        F.least(F.lit(1.0), (1 - keep) * F.coalesce("shape", F.lit(0.0)) + keep * content))
    return branches.join(own, keys).select(
        *keys, F.col("m").cast("bigint").alias("pages"), importance.alias("importance"),
        F.when(F.col("chars") > 0, F.col("links") / F.col("chars")).alias("link_share"))


def main_text(html: str, low: set[str], boxes: set[str] | frozenset = frozenset()) -> str:
    """The article of a page; ``low`` holds the paths of its host's unimportant branches, ``boxes`` those
    that besides are mostly links. Inside a container of the article only ``boxes`` are removed."""
    nodes, blocks = read_page(html)
    if not blocks:
        return ""
    first = [is_chrome(n, False) and n.tag != "header" and "header" not in n.names for n in nodes]
    held = containers(nodes, inherited(nodes, first.__getitem__))
    inside = inherited(nodes, held.__contains__)

    def unimportant(i):
        node = nodes[i]
        if node.path not in low or i in held or node.tag in ROOTS:
            return False
        return not inside[i] or (node.path in boxes and node.tag not in PROSE)

    gone = inherited(nodes, lambda i: is_chrome(nodes[i], inside[i]) or unimportant(i))
    return "\n".join(t for at, t, _ in blocks if not gone[at] and (inside[at] or not held))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``; text is never null.

    A null html is empty; a null or odd url belongs to the host without a name; repeated rows are
    each returned, and equal html counts once as a page of its host; null ids stay null. Other columns
    are not read.
    """

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h, set(low or ()), set(boxes or ())) for h, low, boxes in zip(*[batch.column(k).to_pylist() for k in (2, 3, 4)])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    tree = style_tree(pages, url_col, html_col)
    linked = (F.col("link_share") > LINKS_LOW) & F.col("importance").isNotNull()
    box = F.when((F.col("importance") < LOW) & linked, F.col("path"))
    low = written(tree.where((F.col("importance") < LOW) | linked).groupBy("host").agg(
        F.collect_list("path").alias("low"), F.collect_list(box).alias("boxes")), "style-low")
    slim = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        whole_text(html_col).alias("html"), host_of(url_col).alias("host"))
    met = slim.join(low, "host", "left").select("page_id", "url", "html", "low", "boxes")
    return met.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
