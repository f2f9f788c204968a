"""Main text of web pages by a style tree per site.

The pages of one host are merged into a tree whose nodes are element paths (tags with class or
id, digits in them as one sign).  A node's presentation is the sequence of its children, its content the text of the
blocks below it.  Importance follows entropy: content that recurs on many pages of the site says little, and
so does a node that looks the same everywhere.  Branches of low importance are removed from
each page; what remains is cut into blocks, one line each.

    content(node)      1 - mean over its blocks of log(pages with that block) / log(pages of the site)
    presentation(node) entropy of its child sequences over pages, in logarithms to the base of their number
    own(node)          (1 - DAMP) * presentation + DAMP * content, on hosts of two pages or more
    prior(path)        mean of own over these hosts, with PRIOR_HOSTS more that say 1; 1 for a path whose last
                       element has no class or id, for such paths mean something else on each site
    importance         mean of own, weighted by the pages of the host, and of prior, weighted by PRIOR_PAGES

So hosts of any size have a tree: a small one is judged mostly by what the same named path is on other hosts.

Elements whose tag, role, or a whole class or id says that they are not part of an article are removed on any site;
names that may be a topic (related, legal, search) are left to the tree.  Unnamed paragraphs, headings, lists and tables of
an ``article`` or ``main`` element are kept even where a site repeats them.  Text outside such an element, on a page that has
one, needs the higher importance ``LEAST_OUTSIDE``.

Pages count by their html: copies of a page on one host are one page of the site.

All work of a page is one bounded call; the trees are aggregates over (host, path, content), summed before the
shuffle, so one host with most pages is no hot key.

Marks are read as the HTML standard reads them: a quote opens a value only right after ``=``, raw elements end at their end
tag only, a comment without an end lasts to the end of the page.  Two rules differ, so that no text is lost: a ``<`` without any
later ``>`` is text, and from a tag that a quote would carry to the end of the page on, tags end at the next ``>``.  Time is linear in the page.
Elements nested deeper than ``DEEPEST`` are placed beside each other, as browsers do; their text stays.
Blocks more than ``TREE_DEPTH`` blocks deep count to the node above them.

Edge cases: null or empty html gives an empty text; unclosed and stray tags are tolerated; pages without
tags are one block; a null url belongs to an empty host; repeated rows stay; other columns pass through
``extract``, and an input column called like an output column raises ``ValueError``.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesprep.llm.byte_bpe import slices
from seriesprep.llm.common import query, small, stage, table

DAMP = 0.9
LEAST_IMPORTANCE = 0.35
LEAST_OUTSIDE = 0.6  # of text outside the article or main elements of a page
PRIOR_PAGES = 5.0
PRIOR_HOSTS = 2.0
DEEPEST = 512
TREE_DEPTH = 64
LONGEST_NAME = 80  # longer names stand in paths by a hash

# Fixed values of the HTML standard.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = set("script style textarea title iframe xmp noembed noframes".split())  # their content is no markup
FOREIGN = {"svg", "math"}
ENCLOSED = FOREIGN | set("noscript template canvas object select".split())  # nothing in them is text of an article
CLOSED_BY_BLOCK = {"p"}
CLOSED_BY_OWN = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

NOISE_TAGS = RAW | ENCLOSED | set("head nav footer aside form button menu dialog label input".split())
MAIN_TAGS = {"article", "main"}
# Names that tell no topic and no layout: they remove an element by themselves.  Others (related, search, legal, discussion,
# comments of a review, notices) are left to the style tree.
NOISE_NAMES = set(
    "ad ads advert adverts advertisement advertisements advertising banner banners breadcrumb breadcrumbs comment comments replies cookie cookies consent footer footers "
    "masthead menu menus nav navs navbar navigation newsletter newsletters pagination pager popup popups modal modals promo promos promoted share sharing "
    "sidebar sidebars skip social sponsor sponsors sponsored subscribe toolbar widget widgets login signup".split()
)
# Words that may stand beside such a name in one class or id without changing what it says.
BESIDE = NOISE_NAMES | set(
    "area bar block box bottom buttons center column form global group inner inline item items left link links list main mobile outer page panel post primary "
    "right row secondary section site slot sticky text top unit user users header headers".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
WHOLE = {"html", "body", "article", "main"}
PLAIN = HEADINGS | set("p li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th caption figure figcaption".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())

_ATTRIBUTE = r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>][^\s>]*+)|(?=>)))?+"""
ATTRIBUTE = re.compile(_ATTRIBUTE)
# Possessive throughout: a character is passed once, whatever follows.
TAG = re.compile(r"([a-zA-Z][^\s/>]*+)((?:[\s/]*+" + re.sub(r"\((?=\[)", "(?:", _ATTRIBUTE) + r")*+)([\s/]*+)>")
NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
RAW_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I) for tag in RAW}
DIGITS = re.compile(r"\d+")


def noise_name(own: dict[str, str], tag: str, main: bool) -> bool:
    """Whether class or id name the element as no part of an article.

    Each class counts as a whole: modifiers such as ``with-sidebar`` or ``no-ads`` say nothing, for a word beside the name
    changes it.  Headings are never named away, nor is a section of an article whose id is its topic.
    """
    if tag in WHOLE or tag in HEADINGS:
        return False
    for kind in ("class", "id"):
        if kind == "id" and main and tag == "section":
            continue
        for name in own.get(kind, "").lower().split():
            words = [w for w in re.split(r"[_-]+", name) if w and not w.isdigit()]
            if not NOISE_NAMES.isdisjoint(words) and BESIDE.issuperset(words):
                return True
            if not main and words and words[-1] in ("header", "headers") and BESIDE.issuperset(words):
                return True
    return False


def path_name(tag: str, own: dict[str, str]) -> str:
    """An element's step in a path: tag with first class, or else id.  Numbers differ from page to page, so all are one."""
    if own.get("class"):
        sign, name = ".", own["class"].split()[0]
    elif own.get("id"):
        sign, name = "#", own["id"]
    else:
        return tag
    name = DIGITS.sub("0", name).replace(">", " ")
    return tag + sign + (name if len(name) <= LONGEST_NAME else xxhash.xxh64_hexdigest(name))


class Element:
    """An open element: ``block`` is the innermost block element at it, ``hidden`` tells noise and ``doubtful`` low importance."""

    __slots__ = ("tag", "path", "level", "main", "hidden", "doubtful", "enclosed", "below", "block")

    def __init__(self, tag, path, level, main, hidden, doubtful, enclosed, block):
        self.tag, self.path, self.level, self.main, self.hidden, self.doubtful = tag, path, level, main, hidden, doubtful
        self.enclosed, self.below, self.block = enclosed, [], block or self


class Page:
    """One pass over the marks of a page: its blocks and its elements.

    ``blocks``: ``(path, in main element, noise, text)``; ``children``: path to child sequences.  ``removed`` are paths of
    branches to leave out, ``doubtful`` those to leave out of ``text`` where the page has a main element elsewhere.
    """

    def __init__(self, source: str, removed: frozenset[str] = frozenset(), doubtful: frozenset[str] = frozenset()):
        self.blocks: list[tuple[str, bool, bool, str]] = []
        self.doubts: list[bool] = []
        self.children: list[tuple[str, str]] = []
        self.removed, self.doubtful = removed, doubtful
        self.open: list[Element] = [Element("", "", 0, False, False, False, False, None)]
        self.parts: list[str] = []
        self._read(source)
        self._flush()
        while len(self.open) > 1:
            self._close()

    def _read(self, source: str) -> None:
        at, done, plain = 0, 0, False  # text from done on is not passed on yet
        while (at := source.find("<", at)) >= 0:
            closing = source.startswith("/", at + 1)
            name = NAME.match(source, at + 1 + closing)
            if name is None and not closing and source[at + 1 : at + 2] not in ("!", "?"):
                at += 1  # a sign in the text
                continue
            if source.startswith("<!--", at):
                end = source.find("-->", at + 2)
                end = end + 3 if end >= 0 else len(source)
                mark = None
            else:
                mark = None if plain or name is None else TAG.match(source, name.start())
                if mark is None:
                    plain = plain or name is not None
                    end = source.find(">", at) + 1
                    if not end:
                        break
                else:
                    end = mark.end()
            if at > done:
                self._text(source[done:at])
            if name is not None:
                tag = name[0].lower()
                rest = mark[2] if mark else source[name.end() : end - 1]
                if closing:
                    self._end(tag)
                elif tag in RAW:
                    over = RAW_ENDS[tag].search(source, end)
                    end = over.end() if over else len(source)
                else:
                    self._start(tag, rest)
                    # Only foreign elements can close themselves; a sign at the end of an unquoted value closes nothing.
                    if tag in FOREIGN and (mark[3] if mark else rest).rstrip().endswith("/"):
                        self._end(tag)
            at = done = end
        self._text(source[done:])

    def _text(self, part: str) -> None:
        """Text inside the open block, unless an inline element around it is noise."""
        top = self.open[-1]
        if part and (not top.hidden or top.block.hidden):
            self.parts.append(html.unescape(part) if "&" in part else part)

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts.clear()
            if text:
                block = self.open[-1].block
                self.blocks.append((block.path, block.main, block.hidden, text))
                self.doubts.append(block.doubtful)

    def _close(self) -> None:
        gone = self.open.pop()
        if gone.below:
            self.children.append((gone.path, ",".join(gone.below)))

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            self._close()

    def _start(self, tag: str, rest: str) -> None:
        if tag in VOID:
            if tag == "hr":
                self._flush()
            elif tag == "br":
                self.parts.append(" ")
            return
        block = tag in BLOCKS and not self.open[-1].enclosed  # what is never shown cuts no block in two
        if block:
            self._flush()
            self._imply(tag)
        if len(self.open) > DEEPEST:
            if self.open[-1].block is self.open[-1]:
                self._flush()
            self._close()
        above = self.open[-1]
        own = {}
        if rest:
            for k, a, b, c in ATTRIBUTE.findall(rest):
                if (k := k.lower()) in ("class", "id", "role"):
                    own.setdefault(k, html.unescape(a or b or c).strip())
        path = above.path
        if block:
            name = path_name(tag, own)
            above.block.below.append(name)
            if above.level < TREE_DEPTH:
                path = f"{path}>{name}"
        main = above.main or tag in MAIN_TAGS
        hidden = above.hidden or tag in NOISE_TAGS or own.get("role", "").lower() in NOISE_ROLES or block and path in self.removed
        hidden = hidden or tag == "header" and not main
        hidden = hidden or bool(own) and noise_name(own, tag, main)
        doubtful = above.doubtful or block and path in self.doubtful
        enclosed = above.enclosed or tag in ENCLOSED and tag not in FOREIGN or tag == "foreignobject"
        self.open.append(Element(tag, path, above.level + block, main, hidden, doubtful, enclosed, None if block else above.block))

    def _imply(self, tag: str) -> None:
        """Close what the start of a block element ends: paragraphs, its own kind, drawings and formulas."""
        depth = len(self.open) - 1
        while depth > 0:
            above = self.open[depth].tag
            if above in CLOSED_BY_BLOCK or above in FOREIGN or above in CLOSED_BY_OWN.get(tag, ()):
                self._close_to(depth)
            elif above in BLOCKS:
                return
            depth -= 1

    def _end(self, tag: str) -> None:
        depth = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag == tag), 0)
        if not depth:
            return
        if self.open[-1].block is not self.open[depth - 1].block:
            if tag not in BLOCKS and tag not in ENCLOSED:
                return  # an inline end tag does not close blocks
            self._flush()
        self._close_to(depth)

    def text(self) -> str:
        kept = [(main, doubt, text) for (_, main, noise, text), doubt in zip(self.blocks, self.doubts) if not noise]
        if any(main for main, _, _ in kept):
            kept = [x for x in kept if x[0] or not x[1]]
        return "\n".join(text for _, _, text in kept)


def host(url) -> F.Column:
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def style_tree(pages: DataFrame, html_col="html", url_col="url") -> DataFrame:
    """``(host, path, kind, value, pages)``: distinct pages of a host on which a node shows a presentation or a content.

    Each of n rows of one host with the same html weighs 1 / n, so that copies of a page count once.
    """

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            at = 0
            for texts in slices(batch["html"]):
                for source in texts:
                    site, weight = batch["host"][at].as_py(), batch["weight"][at].as_py()
                    at += 1
                    page = Page(source)
                    values = {("p", path, xxhash.xxh64_intdigest(below) >> 1) for path, below in page.children}
                    values |= {("c", path, xxhash.xxh64_intdigest(text) >> 1) for path, _, noise, text in page.blocks if not noise}
                    values.add(("", "", 0))  # the page itself
                    for kind, path, value in values:
                        seen[site, path, kind, value] += weight
            rows = list(seen)
            for a in range(0, len(rows), 50_000):
                part = rows[a : a + 50_000]
                columns = list(zip(*part))
                yield pa.RecordBatch.from_pydict({"host": columns[0], "path": columns[1], "kind": columns[2], "value": columns[3], "pages": [seen[r] for r in part]})

    sources = pages.select(host(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    sources = sources.withColumn("key", F.xxhash64("html")).withColumn("mate", F.xxhash64(F.lit(1), F.col("host"), F.col("html")))
    copies = stage(sources.groupBy("key", "mate").count().filter("count > 1"), "style-copies")
    weighed = sources.join(small(copies), ["key", "mate"], "left").select("host", "html", (1 / F.coalesce("count", F.lit(1))).alias("weight"))
    counted = weighed.mapInArrow(nodes, "host string, path string, kind string, value bigint, pages double")
    return counted.groupBy("host", "path", "kind", "value").agg(F.round(F.sum("pages")).cast("bigint").alias("pages"))


def importance(tree: DataFrame) -> DataFrame:
    """``(host, path, importance)`` of every node of every host."""
    sites = tree.filter("kind = ''").select("host", F.col("pages").alias("m"))
    looks = tree.filter("kind = 'p'").groupBy("host", "path").agg(
        F.sum("pages").alias("n"), F.sum(F.col("pages") * F.log("pages")).alias("plogp"))
    looks = looks.select("host", "path", F.when(F.col("n") > 1, 1 - F.col("plogp") / (F.col("n") * F.log("n"))).otherwise(0.0).alias("presentation"))
    # A block speaks for its own node and for all nodes above it.
    steps = F.split("path", ">")
    above = F.transform(F.sequence(F.lit(2), F.size(steps)), lambda n: F.concat_ws(">", F.slice(steps, 1, n)))
    blocks = tree.filter("kind = 'c'").groupBy("host", "path").agg(F.sum("pages").alias("n"), F.sum(F.col("pages") * F.log("pages")).alias("plogp"))
    above_blocks = blocks.filter(F.size(steps) > 1).select("host", F.explode(above).alias("path"), "n", "plogp")
    says = above_blocks.groupBy("host", "path").agg(F.sum("n").alias("n"), F.sum("plogp").alias("plogp"))
    both = says.join(sites, "host").join(looks, ["host", "path"], "left")
    content = 1 - F.col("plogp") / (F.col("n") * F.log("m"))
    own = F.when(F.col("m") > 1, (1 - DAMP) * F.coalesce("presentation", F.lit(0.0)) + DAMP * content)
    nodes = stage(both.select("host", "path", "m", own.alias("own")), "style-own")
    named = F.element_at(steps, -1).rlike("[.#]")
    prior = nodes.filter(named & F.col("own").isNotNull()).groupBy("path").agg(
        ((F.sum("own") + PRIOR_HOSTS) / (F.count(F.lit(1)) + PRIOR_HOSTS)).alias("prior"))
    pages = F.when(F.col("own").isNull(), 0).otherwise(F.col("m"))
    mean = (pages * F.coalesce("own", F.lit(0.0)) + PRIOR_PAGES * F.coalesce("prior", F.lit(1.0))) / (pages + PRIOR_PAGES)
    return nodes.join(prior, "path", "left").select("host", "path", mean.alias("importance"))


def removable(nodes: DataFrame) -> DataFrame:
    """``(host, paths, doubtful)``: the branches to remove, and those to remove outside a main element."""
    own = F.element_at(F.split("path", ">"), -1)
    protected = F.col("path").rlike(r">(article|main)\b") & own.isin(*PLAIN) | own.isin(*WHOLE)
    low = nodes.filter((F.col("importance") < LEAST_OUTSIDE) & ~protected)
    gone = F.col("importance") < LEAST_IMPORTANCE
    return low.groupBy("host").agg(
        F.sort_array(F.collect_list(F.when(gone, F.col("path")))).alias("paths"),
        F.sort_array(F.collect_list(F.when(~gone, F.col("path")))).alias("doubtful"),
    )


def extract(pages: DataFrame, html_col="html", url_col="url", out="text") -> DataFrame:
    """``pages`` with ``out`` added: the main text of each page."""
    if out in pages.columns:
        raise ValueError(f"the table already has a column {out}")

    @F.arrow_udf("string")
    def text(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known: dict[tuple, frozenset] = {}
        for sources, removed, doubtful in batches:
            done, at = [pa.array([], pa.string())], 0
            for part in slices(sources):
                sets = [[tuple(x or ()) for x in paths.slice(at, len(part)).to_pylist()] for paths in (removed, doubtful)]
                at += len(part)
                pages_text = [Page(s, *(known.setdefault(x, frozenset(x)) for x in both)).text() for s, *both in zip(part, *sets)]
                done.append(pa.array(pages_text, pa.string()))
                if len(known) > 10_000:
                    known.clear()
            yield pa.concat_arrays(done)

    tree = stage(style_tree(pages, html_col, url_col), "style-counts")  # read three times
    gone = stage(removable(importance(tree)), "style-trees").select(F.col("host").alias("_host"), F.col("paths").alias("_gone"), F.col("doubtful").alias("_doubtful"))
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("_row"), host(F.col(url_col)).alias("_site"))
    both = rows.join(small(gone), F.col("_site") == F.col("_host"), "left")
    return both.select("_row.*", text(F.coalesce(F.col("_row")[html_col], F.lit("")), F.col("_gone"), F.col("_doubtful")).alias(out))


@query("op5_html_extract")
def op5(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))
