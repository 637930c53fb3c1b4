"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element and text of a page is a node with a hidden label, content or not.
Potentials connect each node with its parent and with its own features (tag,
words of class, id and role, link, length of the text).  Sum-product messages
go from the leaves to the root and back; they give every text its content
marginal, exactly, as the graph is a tree.

The potentials are fitted.  A page labels itself if exactly one ``article`` or
``main`` holds its text: what is inside it is content, but for parts that name
themselves otherwise (``nav``, ``aside``, class ``comments``).  Its nodes are
counted, the ancestors of the mark aside; so are the names that parts outside the
content go by.  A short list of such names and of names of content (``SEEDS``,
``NAMED``) counts like a few observed parts, so that names which the labelled
pages never use mean something too; what the pages show often enough decides
against the list.  A name that close to all labelled parts of that name show as
no content closes the part: nothing inside is content, whatever it looks like.
A model without counts and seeds (``Model({}, {})``) knows nothing.

Labelled pages are read up to a bounded number (``SAMPLE_PAGES``); all pages,
with or without such marks, are judged by the model.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import on_workers

SAMPLE_PAGES = 2_000
#: Words of names that fewer sampled parts show are passed over.
MIN_SEEN = 2
#: A name closes its parts from so many (with the seeds' own) on, if at most this share of them is content.
CLOSING_SEEN, CLOSING_SHARE = 5.0, 0.02
SEED_WEIGHT = 5.0
THRESHOLD = 0.5
#: The most that one learned feature adds to the log odds of a node.
MOST = 3.0
#: The same for what a text tells by its length and by standing in a link: there are many to a part.
MOST_TEXT = 1.0
#: Log odds of parts that name themselves a form (some pages are one) or content.
NAMED = {"named form": -8.0, "named content": 6.0}
NEVER = -1e6
#: Log odds against the page as a whole being content.
ROOT = 3.0
#: Pseudo-counts by kind of child (texts and inline elements, paragraphs and the
#: like, containers): of keeping the parent's label, of becoming content, and of
#: ceasing to be content, which takes a part that names itself.
KINDS = {"text": (50.0, 0.01, 0.01), "leaf": (50.0, 0.05, 0.01), "container": (50.0, 2.0, 0.01)}

#: HTML's void and raw-text elements, those of foreign content (and
#: where HTML goes on inside these), those that end a paragraph, and words that
#: name parts of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe".split())
FOREIGN = frozenset("svg math".split())
INTEGRATION = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
BLOCKS = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre "
                   "section summary table tbody td tfoot th thead tr ul".split())
SKIPPED = frozenset("script style textarea title noscript template iframe svg select option datalist object head button".split())
OTHER_TAGS = frozenset("nav aside footer header menu dialog button label fieldset template svg select option datalist object".split())
#: Never page text, whatever a model knows: parts of forms, graphics and templates.
NEVER_TEXT = frozenset("menu dialog button label fieldset template svg select option datalist object".split())
CONTENT_TAGS = frozenset("article main".split())
WHOLE_TAGS = frozenset("html body article main".split())
CONTAINERS = frozenset("address article aside body center details dialog div fieldset footer form header html main menu nav section "
                       "table tbody td tr ul ol".split())
OTHER_WORDS = frozenset("ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation "
                        "menu breadcrumb breadcrumbs header masthead footer foot sidebar side aside related share social widget "
                        "comment comments reply replies disqus cookie cookies consent notice notices alert popup modal overlay "
                        "newsletter subscribe signup login form search toolbar pagination copyright legal skip contentinfo "
                        "complementary gdpr privacy".split())
#: Names that count as seen ``SEED_WEIGHT`` times outside the content.
SEEDS = frozenset([f"tag {t}" for t in OTHER_TAGS] + [f"word {w}" for w in OTHER_WORDS])
CONTENT_WORDS = frozenset("article content post entry story main maincontent body text page prose".split())

_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in RAW}


class Node:
    """An element (``text`` is None) or a text; ``named``: what it says it is, if anything."""

    __slots__ = ("tag", "parent", "features", "text", "named", "kind", "closed")

    def __init__(self, tag: str, parent: int, features: tuple = (), text: str | None = None, named: bool | None = None, inner: bool = False):
        self.tag, self.parent, self.features, self.text, self.named = tag, parent, features, text, named
        # apart: goes by a name that closes it, or lies in such a part and isn't content by name;
        # it is no content whatever surrounds it, and says nothing about what surrounds it
        self.closed = "named other" in features or (inner and named is not True)
        self.kind = "apart" if self.closed else "container" if tag in CONTAINERS else "leaf" if tag in BLOCKS else "text"


def _names(attributes: str) -> tuple[set[str], bool, bool]:
    """Words of class, id and role; whether a name by itself is one of another part;
    whether a name is one of content.  In a compound (``main-menu``) a word for
    another part is all that counts."""
    words, other, content = set(), False, False
    for m in _ATTRIBUTE.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            parts = set(_WORD.findall(name))
            strange = parts & OTHER_WORDS
            words |= strange or parts
            other = other or (bool(strange) and len(parts) == 1)
            content = content or (not strange and not parts.isdisjoint(CONTENT_WORDS))
    return words, other, content


def _features(tag: str, attributes: str, closing: frozenset) -> tuple[tuple, bool | None]:
    words, bare, content = _names(attributes)
    content = tag in CONTENT_TAGS or (content and not bare)
    feats = (f"tag {tag}", *(f"word {w}" for w in sorted(words)))
    other = tag in NEVER_TEXT or feats[0] in closing or (tag not in WHOLE_TAGS and not content and not closing.isdisjoint(feats[1:]))
    says = ("named other",) if other else ("named form",) if tag == "form" else ("named content",) if content else ()
    named = False if says and says[0] != "named content" else True if tag in CONTENT_TAGS else None
    return (feats[0], *says, *feats[1:]), named


def parse(page: str | None, closing: frozenset = SEEDS) -> list[Node]:
    """The page's elements and texts in document order; the first is the root.
    Parts that go by a name of ``closing`` are closed.

    Open paragraphs, list items, table cells and options end where HTML ends
    them; an end tag closes what is open inside its element; texts of scripts,
    styles and the like have no node.  Inside svg and math, ``/>`` ends an element
    (elsewhere it means nothing) and HTML's blocks end the graphic or formula.  A tag cut off at the end of the page and
    a comment without an end are dropped.
    """
    nodes = [Node("#root", -1)]
    if not page:
        return nodes
    stack, at, n = [0], 0, len(page)
    foreign = {0: False}    # of open elements: whether their children are foreign content

    def text(raw: str) -> None:
        if raw:
            said = entities.unescape(raw)
            parent = stack[-1]
            linked = any(nodes[i].tag == "a" for i in stack[-4:])
            size = len(said.strip())
            features = (f"length {min(6, size.bit_length() // 2)}", f"link {linked}") if size else ()
            nodes.append(Node("#text", parent, features, said, inner=nodes[parent].closed))

    def close(tags, within=()) -> None:
        for d in range(len(stack) - 1, 0, -1):
            tag = nodes[stack[d]].tag
            if tag in tags:
                del stack[d:]
                return
            if tag in within:
                return

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, end = m[2].lower(), m[1] == "/"
        if not m[0].endswith(">"):
            break
        if end:
            if tag == "br":
                nodes.append(Node("br", stack[-1], inner=nodes[stack[-1]].closed))
            else:
                close((tag,))
            continue
        if tag in BLOCKS and foreign[stack[-1]]:
            close(FOREIGN, INTEGRATION)
        if tag in BLOCKS and tag != "br" and tag != "button":
            close(("p",), ("article", "section", "div", "li", "td", "th", "blockquote", "aside", "main", "body", "form", "button"))
        if tag == "li":
            close(("li",), ("ul", "ol", "menu"))
        elif tag in ("dd", "dt"):
            close(("dd", "dt"), ("dl",))
        elif tag in ("td", "th"):
            close(("td", "th"), ("tr", "table"))
        elif tag == "tr":
            close(("tr",), ("table",))
        elif tag == "option":
            close(("option",), ("select", "datalist"))
        elif tag == "body":
            close(("head",))
        features, named = _features(tag, m[3], closing)
        nodes.append(Node(tag, stack[-1], features, named=named, inner=nodes[stack[-1]].closed))
        inside = foreign[stack[-1]]
        if (inside or tag in FOREIGN) and m[0].endswith("/>"):
            continue
        if tag in RAW:
            stop = _RAW_END[tag].search(page, at)
            if stop is None:
                break
            at = page.find(">", stop.start()) + 1 or n
        elif tag not in VOID:
            foreign[len(nodes) - 1] = tag in FOREIGN or (inside and tag not in INTEGRATION)
            stack.append(len(nodes) - 1)
    return nodes


def labels(nodes: list[Node]) -> list[bool] | None:
    """Labels of a page that marks its own content; None for other pages."""
    marks = [i for i, x in enumerate(nodes) if x.tag in ("article", "main") and x.named]
    if len(marks) != 1 and not (len(marks) == 2 and nodes[marks[1]].parent >= marks[0] and {nodes[i].tag for i in marks} == {"article", "main"}):
        return None
    out = [False] * len(nodes)
    for i, x in enumerate(nodes[1:], 1):
        inside = i == marks[-1] or out[x.parent]
        out[i] = inside and x.named is not False and x.tag not in SKIPPED
    return out


class Model:
    """Potentials in log odds: ``emit[feature]``, and by kind of child
    ``pair[kind][label of the parent][label of the child]`` as log probabilities;
    and the names that close a part.  ``seeds`` count as seen outside the content,
    ``named`` are log odds given to parts that name themselves."""

    def __init__(self, counts: dict[tuple[str, bool], float], pairs: dict[tuple[str, bool, bool], float],
                 seeds: frozenset = frozenset(), named: dict[str, float] | None = None):
        total = [1.0 + sum(v for (f, y), v in counts.items() if f.startswith("tag ") and y == label) for label in (False, True)]
        self.emit = dict(named or {})
        for f in {f for f, _ in counts} - {*NAMED, "named other"}:
            share = [(counts.get((f, y), 0.0) + 0.5) / (total[y] + 1.0) for y in (False, True)]
            most = MOST_TEXT if f.startswith(("length ", "link ")) else MOST
            self.emit[f] = max(-most, min(most, math.log(share[1] / share[0])))
        names = seeds | {f for f, _ in counts if f.startswith("word ") and f[5:] not in CONTENT_WORDS}
        self.closing = frozenset(f for f in names if self._closes(counts.get((f, False), 0.0) + SEED_WEIGHT * (f in seeds), counts.get((f, True), 0.0)))
        self.pair = {"apart": ((0.0, NEVER), (0.0, NEVER))}
        for kind, (stay, enter, leave) in KINDS.items():
            n = {(x, y): pairs.get((kind, x, y), 0.0) + (stay if x == y else enter if y else leave) for x in (False, True) for y in (False, True)}
            self.pair[kind] = tuple(tuple(math.log(n[x, y] / (n[x, False] + n[x, True])) for y in (False, True)) for x in (False, True))

    @staticmethod
    def _closes(other: float, content: float) -> bool:
        return other + content >= CLOSING_SEEN and content <= CLOSING_SHARE * (other + content)

    def marginals(self, nodes: list[Node]) -> list[float]:
        """P(content) of every node: sum-product upward, then downward."""
        n = len(nodes)
        up_o = [0.0] * n
        up_c = [sum(self.emit.get(f, 0.0) for f in x.features) for x in nodes]
        up_c[0] -= ROOT
        msg_o, msg_c = [0.0] * n, [0.0] * n
        for i in range(n - 1, 0, -1):
            (oo, oc), (co, cc) = self.pair[nodes[i].kind]
            o, c = up_o[i], up_c[i]
            msg_o[i], msg_c[i] = _add(oo + o, oc + c), _add(co + o, cc + c)
            p = nodes[i].parent
            up_o[p] += msg_o[i]
            up_c[p] += msg_c[i]
        down_o, down_c = [0.0] * n, [0.0] * n
        out = [0.0] * n
        for i in range(n):
            if i:
                (oo, oc), (co, cc) = self.pair[nodes[i].kind]
                p = nodes[i].parent
                o = down_o[p] + up_o[p] - msg_o[i]
                c = down_c[p] + up_c[p] - msg_c[i]
                high = max(o, c)
                o, c = o - high, c - high
                down_o[i], down_c[i] = _add(oo + o, co + c), _add(oc + o, cc + c)
            d = down_o[i] + up_o[i] - down_c[i] - up_c[i]
            out[i] = 1.0 / (1.0 + math.exp(min(700.0, d)))
        return out


def _add(x: float, y: float) -> float:
    """log(exp(x) + exp(y))"""
    return x + math.log1p(math.exp(y - x)) if x > y else y + math.log1p(math.exp(x - y))


def seeded() -> Model:
    """A model of the seeds alone, for tables without a labelled page."""
    return Model({}, {}, SEEDS, NAMED)


def observed(nodes: list[Node], got: list[bool]) -> Iterator[tuple[str, bool]]:
    """What a labelled page shows: ``(feature, label)`` of every part but the
    ancestors of its content, and the pairs of labels."""
    above = set()
    for i in range(len(nodes) - 1, 0, -1):
        if (got[i] or i in above) and not got[nodes[i].parent]:
            above.add(nodes[i].parent)
    for i, x in enumerate(nodes[1:], 1):
        # tags and words inside a part that closed tell nothing of their own
        told = () if i in above else x.features if x.kind != "apart" or x.text is not None else (
            f for f in x.features if "named other" in x.features and f.startswith("word "))
        for f in told:
            yield f, got[i]
        yield f"pair {x.kind} {got[x.parent]}", got[i]


def fit(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Model:
    """Counts of the self-labelled pages among about ``sample_pages`` different
    ones (by a hash of the page); a page that repeats counts once.  What the
    driver gets is bounded by the sample: the names its pages use."""
    on_workers(pages.sparkSession)
    rate = min(1.0, sample_pages / max(1, pages.count()))
    some = pages.select(F.col(html_col).alias("html")).filter(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int((1 << 30) * rate)).distinct()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c: Counter = Counter()
            for page in b["html"]:
                nodes = parse(page)
                got = labels(nodes)
                if got is not None:
                    c.update(observed(nodes, got))
            yield pd.DataFrame([(f, y, n) for (f, y), n in c.items()], columns=["feature", "label", "n"])

    sums = (some.mapInPandas(count, "feature string, label boolean, n long").groupBy("feature", "label").agg(F.sum("n").alias("n"))
            .filter((F.col("n") >= MIN_SEEN) | ~F.col("feature").startswith("word ")).collect())
    pairs = {(r.feature.split()[1], r.feature.endswith("True"), r.label): float(r.n) for r in sums if r.feature.startswith("pair ")}
    return Model({(r.feature, r.label): float(r.n) for r in sums if not r.feature.startswith("pair ")}, pairs, SEEDS, NAMED)


def content_of(page: str | None, model: Model) -> str:
    """The content texts in page order: white space inside a block is one space,
    blocks are trimmed and joined by one space."""
    nodes = parse(page, model.closing)
    marginal = model.marginals(nodes)
    blocks: list[list[str]] = [[]]
    edge: list[int] = []    # open block elements around the current text
    for i, x in enumerate(nodes):
        if x.text is None:
            if x.tag in BLOCKS:
                blocks.append([])
            continue
        around = _block(nodes, x.parent)
        if edge != around:
            blocks.append([])
            edge = around
        if marginal[i] > THRESHOLD:
            blocks[-1].append(x.text)
    return " ".join(t for b in blocks if (t := " ".join("".join(b).split())))


def _block(nodes: list[Node], i: int) -> list[int]:
    while i > 0 and nodes[i].tag not in BLOCKS:
        i = nodes[i].parent
    return [i]


def extract(pages: DataFrame, model: Model | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page; text is empty where none
    is content, as with a NULL or empty page.  Repeated pages stay repeated."""
    on_workers(pages.sparkSession)
    handle = pages.sparkSession.sparkContext.broadcast(model or fit(pages, html_col))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            text = [content_of(p, handle.value) for p in b["html"]]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": text, "n_chars": [len(t) for t in text]})

    return pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html")).mapInPandas(
        run, "page_id string, url string, text string, n_chars long").withColumn("page_id", F.col("page_id").cast("long"))
