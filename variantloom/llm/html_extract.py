"""Main text of web pages by consensus of the pages of a host.

Every page scores its containers by the text of their blocks. It votes for the outermost main or article around the
best one or, without such, for the innermost container that holds the best one and all blocks beside it that are not
mostly links. A vote is for a path of tags and classes, generalised by leaving out positions and numbers. Spark sums the
votes of each host, and each page is extracted anew from all its containers on the path that has most votes among
those it has itself; of equal ones the first by name.

Blocks inside menus, headers, footers, asides, forms, scripts, styles, notices, adverts and reader comments are
left out, whether the tag or the class, id or role says so; a body, main or article is never left
out for its class, nor is an element around one. A name counts for nothing after with, has, no and the like
(``with-sidebar``), nor on an element that holds most of the page's unlinked text, unless that text lies beside a
main or article. Comments of readers may be longer than the article: they stay left out if unlinked text
without them is left and they hold no h1. Character references are decoded, white space inside a block
becomes one space, and blocks are joined by two line feeds in page order.

A null or empty page, or one without text, gives the empty string. A null url is host ''. Repeated rows vote and
are returned each. Broken markup is read leniently: unclosed elements end with their parents.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from variantloom.llm.common import OUT_ROWS, batches, stored

RAW = "script|style|noscript|template|textarea|iframe|svg|xmp|noframes|noembed"
# Outside quotes a tag ends before the next ``<``, and what opens with ``<!`` or ``<?`` ends with the page at the latest: a page of
# unclosed tags is read once, not once for each of them.
TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<({RAW})\b[^<>]*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][\w:-]*+)((?>[^<>"']|"[^"]*"|'[^']*')*+)>""",
    re.S | re.I)
# Longer paths go by a digest, so that a page of deeply nested elements does not hold the square of its depth.
MOST_PATH = 512
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
NAME = re.compile(r"\S+")
SPACE = re.compile(r"\s+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/:?#]+)"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div td table center".split())
BLOCKS = CONTAINERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre tr th tbody thead tfoot figure figcaption address details "
    "summary fieldset legend hgroup header footer nav aside form head title select option button menu dialog caption hr".split())
LEFT_OUT_TAGS = frozenset("head nav header footer aside form select option button menu dialog fieldset title object audio video canvas".split())
NEVER_LEFT_OUT = frozenset("html body main article".split())
LEFT_OUT_NAMES = frozenset((
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs header masthead topbar footer sidebar sidebars aside ad ads adv "
    "advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promos promotion banner banners cookie "
    "cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations comment comments disqus replies respond pagination pager toolbar skip search "
    "contentinfo complementary dialog widget").split())
NEGATED_BY = frozenset("with without has have no non not".split())
READER_NAMES = frozenset("comment comments disqus replies respond".split())
# A start tag of these ends an open element of the same kind.
ENDS_SAME = frozenset("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())
# Pages of a host that one task ranks, until hosts beyond it could be more than MOST_HOT: these are broadcast.
HOST_PAGES, MOST_HOT = 5_000, 1_000


class Element:
    __slots__ = ("tag", "parent", "path", "named_out", "by_readers", "left_out", "around_main", "score")

    def __init__(self, tag, parent, attributes):
        self.tag, self.parent, self.around_main, self.score = tag, parent, False, 0.0
        classes, names = [], set()
        for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
            value = values[0] or values[1] or values[2]
            for whole in NAME.findall(value):
                for part in map(str.lower, NAME_PART.findall(whole)):
                    if part in NEGATED_BY:
                        break
                    names.add(part)
            if name.lower() == "class":
                classes = sorted({re.sub(r"\d+", "", c) for c in value.split()} - {""})
        step = ".".join([tag, *classes])
        path = f"{parent.path}/{step}" if parent else step
        self.path = path if len(path) <= MOST_PATH else "#" + hashlib.sha256(path.encode("utf-8", "replace")).hexdigest()
        self.named_out = tag not in NEVER_LEFT_OUT and not LEFT_OUT_NAMES.isdisjoint(names)
        self.by_readers = self.named_out and not READER_NAMES.isdisjoint(names)
        self.left_out = tag in LEFT_OUT_TAGS


def parse(page):
    """Blocks ``(element, text, share of link text)`` in page order, and all containers."""
    root = Element("", None, "")
    at, text, linked, in_link = root, [], 0, False
    blocks, containers, open_tags = [], [], Counter()

    def leave():
        nonlocal at
        open_tags[at.tag] -= 1
        at = at.parent

    def flush():
        nonlocal text, linked
        if text:
            whole = SPACE.sub(" ", html.unescape("".join(text))).strip()
            if whole:
                blocks.append((at, whole, min(1.0, linked / len(whole))))
            text, linked = [], 0

    end = 0
    for token in TOKEN.finditer(page):
        if token.start() > end:
            part = page[end:token.start()]
            text.append(part)
            linked += len(part) if in_link else 0
        end = token.end()
        tag = token[3]
        if tag is None:
            continue
        tag, closes = tag.lower(), token[2] == "/"
        if tag not in BLOCKS and tag not in LEFT_OUT_TAGS:
            if tag == "a":
                in_link = not closes
            elif tag == "br":
                text.append(" ")
            continue
        flush()
        if tag in VOID:
            continue
        if closes:
            if open_tags[tag]:
                while at.tag != tag:
                    leave()
                leave()
            in_link = False
            continue
        if tag in ENDS_SAME or at.tag == "p":
            up = at
            while up is not root and up.tag not in CONTAINERS and up.tag not in ("ul", "ol", "dl", tag):
                up = up.parent
            if up.tag == tag and tag in ENDS_SAME:
                while at is not up:
                    leave()
                leave()
            elif at.tag == "p":
                leave()
        at = Element(tag, at, token[4])
        open_tags[tag] += 1
        if tag in CONTAINERS:
            containers.append(at)
        if tag in ("main", "article"):
            up = at.parent
            while up is not None and not up.around_main:
                up.around_main = True
                up = up.parent
    if end < len(page):
        text.append(page[end:])
    flush()
    keep_large(blocks)
    return [b for b in blocks if not left_out(b[0])], containers


def keep_large(blocks):
    """Take back the verdict by name on elements that hold most of the page's unlinked text."""
    total, in_main, held, titled = 0.0, 0.0, {}, set()
    for element, text, linked in blocks:
        named, up, main, title = [], element, False, False
        while up is not None and not up.left_out:
            if up.named_out and not up.around_main:
                named.append(up)
            main |= up.tag in ("main", "article")
            title |= up.tag == "h1"
            up = up.parent
        if up is not None:
            continue
        worth = len(text) * (1 - linked)
        total += worth
        in_main += worth if main else 0
        for up in named:
            held[up] = held.get(up, 0.0) + worth
        if title:
            titled.update(named)
    for element, worth in held.items():
        if 2 * worth <= total or (in_main and outermost_main(element) is None):
            continue
        if not element.by_readers or element in titled or worth == total:
            element.named_out = False


def outermost_main(element):
    """The outermost main or article that the element is or is in; None if there is none."""
    found = None
    while element is not None:
        if element.tag in ("main", "article"):
            found = element
        element = element.parent
    return found


def left_out(element):
    while element is not None:
        if element.left_out or (element.named_out and not element.around_main):
            return True
        element = element.parent
    return False


def scored(page):
    """Parsed blocks and the containers that got a score: whole for their own blocks, less for those further in."""
    blocks, containers = parse(page)
    for element, text, linked in blocks:
        worth = len(text) * (1 - linked)
        while element is not None and worth >= 1:
            if element.tag in CONTAINERS:
                element.score += worth
                worth /= 2
            element = element.parent
    holding = {e for block in blocks for e in around(block[0])}
    return blocks, [c for c in containers if c in holding]


def around(element):
    while element is not None:
        yield element
        element = element.parent


def best(containers, blocks):
    """The outermost main or article around the container of the highest score, the first in page order of equal ones.

    Without such, the innermost container that holds it and all blocks that are not mostly links.
    """
    top = max(containers, key=lambda c: c.score)
    main = outermost_main(top)
    if main is not None:
        return main
    held = Counter(e for element, _, linked in blocks if linked < 0.5 for e in around(element))
    for outer in around(top):
        if outer.tag in CONTAINERS and held[outer] > held[top]:
            top = outer
    return top


def extract_text(page, paths):
    """Text of all containers on the first of ``paths`` that the page has, else of its own best one's path."""
    blocks, containers = scored(page)
    if not blocks:
        return ""
    if not containers:
        return "\n\n".join(text for _, text, _ in blocks)
    own = {c.path for c in containers}
    path = next((p for p in paths if p in own), None) or best(containers, blocks).path
    chosen = {c for c in containers if c.path == path}
    return "\n\n".join(text for element, text, _ in blocks if not chosen.isdisjoint(around(element)))


def page_rows(pages, id_col, url_col, html_col):
    url = F.col(f"`{url_col}`").cast("string")
    return pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), url.alias("url"),
                        F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit("")).alias("host"),
                        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))


def page_paths(rows):
    """``k1, k2, host, path, own`` of every path of every page; ``own``: the page votes for it."""
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("own", pa.bool_())])

    def run(source):
        for batch in source:
            def found(batch=batch):
                for k1, k2, host, page in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                    blocks, containers = scored(page.as_py())
                    if containers:
                        own = best(containers, blocks).path
                        for path in sorted({c.path for c in containers}):
                            yield k1, k2, host, path, path == own
            yield from batches(found(), schema)

    return rows.select("k1", "k2", "host", "html").mapInArrow(run, "k1 long, k2 long, host string, path string, own boolean")


def chosen_paths(rows, host_pages=HOST_PAGES):
    """``k1, k2, path``: of a page's paths, the one with most votes of its host; of equal ones the first by name."""
    found = stored(page_paths(rows))
    votes = stored(found.filter("own").groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes")))
    pages = votes.agg(F.sum("votes").alias("n")).first()["n"] or 0
    share = max(host_pages, -(-pages // MOST_HOT))
    hot = votes.groupBy("host").agg(F.sum("votes").alias("n")).filter(F.col("n") > share).select(
        "host", F.ceil(F.col("n") / share).cast("int").alias("salts"))
    with_salts = lambda df: df.join(F.broadcast(hot), "host", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    salted = with_salts(votes).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    ranked = with_salts(found).withColumn("salt", F.pmod("k2", "salts").cast("int")).join(salted, ["host", "path", "salt"])
    return ranked.groupBy("k1", "k2").agg(F.min(F.struct(-F.col("votes"), "path"))["path"].alias("path"))


def extract(pages, id_col="page_id", url_col="url", html_col="html"):
    """``page_id, url, text`` of every row. A host of many pages is dealt out over salts by their number, so it is many tasks' work."""
    rows = page_rows(pages, id_col, url_col, html_col).select(
        F.coalesce("page_id", F.lit(-(1 << 63))).alias("k1"), F.xxhash64("page_id", "url", "html").alias("k2"), "*")
    joined = rows.join(chosen_paths(rows), ["k1", "k2"], "left").select("page_id", "url", "html", "path")
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(source):
        for batch in source:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                texts = [extract_text(page.as_py(), (path,)) for page, path in zip(part.column(2), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], schema=schema)

    return joined.mapInArrow(run, "page_id long, url string, text string")
