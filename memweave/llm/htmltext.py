"""Main text of web pages by boosted trees over DOM nodes.

A page is cut into tags and texts and built into a tree (implied end tags,
void and raw-text elements as in HTML). Every rendered element that holds text
gets features: its tag, the meaning of the tokens in its class, id and role,
the same of its ancestors, depth, text and link density of its subtree, and
its place among its siblings. Boosted trees estimate whether the element
belongs to the article (or holds it). Decoding is hierarchical: the labelling
of the whole tree with the highest likelihood is chosen under the rule that
nothing below a dropped element is kept, so choices cannot contradict. Phrase
elements (bold, emphasis and the like) beside text go with the element that
holds that text.

If no text is kept although ``FALLBACK_CHARS`` characters stand outside links
and outside everything marked as something else, the smallest element that
holds half of these is taken for the article.

The trees are fitted on pages laid out by ``training.layouts`` from a seed and
on a bounded sample of the table's own pages (``train_pages``, the first by a
hash of the html) that have an ``article`` or ``main`` landmark, whose labels
come from their landmarks.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one newline; blocks without text vanish.

Edge cases: null and empty pages give an empty text; a page without markup is
one block; unclosed or crossed tags are repaired; repeated rows give equal
results; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from memweave.llm.boosting import BoostedTrees
from memweave.llm.sampling import first_by_hash

#: HTML element classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style title textarea xmp iframe noembed noframes noscript template svg math object select option datalist audio video canvas".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3
h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul""".split())
CLOSES_P = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "legend", "summary"}
#: An opening tag ends open elements of these kinds, up to the nearest of the given containers.
IMPLIED_END = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
               "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
               "tbody": (("tbody", "thead", "tfoot"), ("table",)), "tfoot": (("tbody", "thead"), ("table",)), "option": (("option",), ("select",))}

#: Tokens of class, id and role attributes, by what they tell.
TOKEN_GROUPS = {
    "content": "article articlebody post postbody posttext entry content contents story maincontent main bodytext articletext prose text blogpost news",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs topbar tabs pagination pager toc sitemap skip toolbar mainmenu",
    "head": "header masthead banner hero logo branding head sitehead siteheader",
    "foot": "footer foot copyright legal colophon contentinfo bottom sitefooter imprint",
    "side": "sidebar aside rail widget widgets related recommended recommendations trending popular complementary teaser teasers side more",
    "ad": "ad ads adv advert advertisement adverts sponsor sponsored promo promotion promoted adsense dfp commercial adslot adbox",
    "comment": "comment comments commentlist disqus reply replies respond discussion thread reader readers reactions",
    "notice": "cookie cookies consent notice gdpr popup modal overlay alert dialog disclaimer banner2 newsletter subscribe signup paywall toast alertdialog",
    "share": "share sharing social follow facebook twitter tags tag meta byline author bio rating",
    "form": "form search login register contact searchbox feedback survey poll",
    "hidden": "hidden invisible sronly offscreen",
}
GROUPS = list(TOKEN_GROUPS)
TOKEN_BIT = {t: 1 << k for k, g in enumerate(GROUPS) for t in TOKEN_GROUPS[g].split()}
TAG_BIT = {"article": 1, "main": 1, "nav": 2, "menu": 2, "header": 4, "footer": 8, "aside": 16, "dialog": 1 << 7, "form": 1 << 9, "search": 1 << 9,
           "button": 1 << 9, "fieldset": 1 << 9, "label": 1 << 9}
#: Phrase elements: part of the text around them.
PHRASE = frozenset("abbr b bdi bdo cite code data del dfn em font i ins kbd mark q s samp small strike strong sub sup time tt u var wbr span".split())
LINE_TAGS = frozenset("p h li td blockquote".split())
#: Tags with a feature of their own; headings and list items share one each.
TAGS = {t: k for k, t in enumerate("p h li div section article main nav header footer aside form ul td table blockquote figure a span body".split())}
TAG_ALIAS = {**{f"h{k}": "h" for k in range(1, 7)}, "dt": "li", "dd": "li", "ol": "ul", "dl": "ul", "th": "td", "tr": "table", "tbody": "table",
             "pre": "blockquote", "figcaption": "figure", "html": "body"}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.DOTALL)
ATTRIBUTE = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)""", re.IGNORECASE)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
SENTENCE = re.compile(r"[.!?,;:]")


#: Pages above this length are no training pages, so that the sample stays small on the driver.
TRAIN_CHARS = 100_000
#: A page with less plain text than this and nothing kept has no article.
FALLBACK_CHARS = 140
#: All marks but that of content.
OTHER = ~1 & (1 << len(GROUPS)) - 1


class Page:
    """Tree of one page: parallel lists over elements in page order; element 0 is the root."""

    def __init__(self, html: str):
        self.tag, self.parent, self.mask, self.hidden = ["html"], [-1], [0], [False]
        self.items: list[tuple[int, object]] = []  # (element, text) or (element, None) at a block border, in page order
        self._build(html)

    def _open(self, tag: str, attributes: str, stack: list[int]) -> int:
        mask = TAG_BIT.get(tag, 0)
        if attributes:
            for value in ATTRIBUTE.findall(attributes):
                value = value.strip("\"'")
                for part in PART.findall(value):
                    mask |= TOKEN_BIT.get(part.lower(), 0)
                for whole in value.split():
                    mask |= TOKEN_BIT.get(re.sub(r"[^a-z]", "", whole.lower()), 0)
        self.tag.append(tag)
        self.parent.append(stack[-1])
        self.mask.append(mask)
        self.hidden.append(tag in HIDDEN or self.hidden[stack[-1]])
        return len(self.tag) - 1

    def _build(self, html: str) -> None:
        stack, opened, at = [0], {"html": 1}, 0
        tags, items = self.tag, self.items

        def text(chunk: str) -> None:
            if not self.hidden[stack[-1]]:
                items.append((stack[-1], unescape(chunk) if "&" in chunk else chunk))

        def pop_to(depth: int) -> None:
            while len(stack) > depth:
                name = tags[stack.pop()]
                opened[name] -= 1
                if name in BLOCK:
                    items.append((stack[-1], None))

        def end_nearest(names: tuple, borders: tuple) -> None:
            if any(opened.get(x) for x in names):
                for k in range(len(stack) - 1, 0, -1):
                    name = tags[stack[k]]
                    if name in names:
                        return pop_to(k)
                    if name in borders:
                        return None
            return None

        while m := TOKEN.search(html, at):
            if m.start() > at:
                text(html[at:m.start()])
            at = m.end()
            closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue
            name = name.lower()
            if closing:
                if opened.get(name) and name not in ("html", "body"):
                    for k in range(len(stack) - 1, 0, -1):
                        if tags[stack[k]] == name:
                            pop_to(k)
                            break
                continue
            if name in ("html", "body") and opened.get(name):
                continue
            if name == "body":
                end_nearest(("head",), ())
            if name in CLOSES_P:
                end_nearest(("p",), ("table", "td", "th", "button", "object"))
            if name in IMPLIED_END:
                end_nearest(*IMPLIED_END[name])
            if name in BLOCK:
                items.append((stack[-1], None))
            elif name == "br":
                text(" ")
            if name in VOID:
                continue
            node = self._open(name, attributes, stack)
            if name in RAW:
                close = re.compile("</" + name + r"\b[^>]*>?", re.IGNORECASE).search(html, at)
                at = close.end() if close else len(html)
            elif not attributes.endswith("/"):
                stack.append(node)
                opened[name] = opened.get(name, 0) + 1
            elif name not in ("svg", "path"):  # a slash does not close an HTML element
                stack.append(node)
                opened[name] = opened.get(name, 0) + 1
        if at < len(html):
            text(html[at:])

    def features(self) -> np.ndarray:
        """One row per element."""
        n = len(self.tag)
        parent, tag, mask = self.parent, self.tag, self.mask
        chars, links, marks, paras, below = [0] * n, [0] * n, [0] * n, [0] * n, [1] * n
        depth, above, in_link = [0] * n, [0] * n, [False] * n
        own = self.own = [0] * n
        place, brothers, alike = [0] * n, [0] * n, [0] * n
        count: list[dict] = [{} for _ in range(n)]
        for k in range(1, n):
            up = parent[k]
            depth[k], above[k], in_link[k] = depth[up] + 1, above[up] | mask[up], in_link[up] or tag[k] == "a"
            place[k] = brothers[up]
            brothers[up] += 1
            count[up][tag[k]] = count[up].get(tag[k], 0) + 1
        for node, chunk in self.items:
            if chunk:
                size = len(chunk) if not chunk.isspace() else 0
                chars[node] += size
                own[node] += size
                marks[node] += len(SENTENCE.findall(chunk)) if size else 0
                if in_link[node]:
                    links[node] += size
        for k in range(n - 1, 0, -1):
            up = parent[k]
            chars[up] += chars[k]
            links[up] += links[k]
            marks[up] += marks[k]
            paras[up] += paras[k] + (tag[k] == "p")
            below[up] += below[k]
        self.chars = chars
        self.in_link = in_link
        total = max(chars[0], 1)
        out = np.zeros((n, len(TAGS) + 2 * len(GROUPS) + 14), np.float32)
        bits = np.arange(len(GROUPS))
        for k in range(n):
            group = TAGS.get(TAG_ALIAS.get(tag[k], tag[k]))
            if group is not None:
                out[k, group] = 1
            up = max(parent[k], 0)
            alike[k] = count[up].get(tag[k], 1)
        t = len(TAGS)
        out[:, t:t + len(GROUPS)] = np.array(mask)[:, None] >> bits & 1
        out[:, t + len(GROUPS):t + 2 * len(GROUPS)] = np.array(above)[:, None] >> bits & 1
        c, up = np.array(chars, float), np.maximum(np.array(parent), 0)
        b = np.array(below, float)
        many = np.maximum(np.array(brothers, float)[up], 1)
        out[:, t + 2 * len(GROUPS):] = np.stack([
            np.log1p(c), np.array(links) / np.maximum(c, 1), np.log1p(c / b), np.log1p(paras), np.array(marks) / np.maximum(c, 1) * 10, depth,
            np.array(place) / many, np.log1p(many), np.array(alike) / many, c / np.maximum(c[up], 1), c / total, np.log1p(b),
            np.log1p(c[up]), np.full(n, any(m & 1 and size for m, size in zip(mask, chars)))], axis=1)
        return out

    def decode(self, p: np.ndarray) -> np.ndarray:
        """Kept elements: the likeliest labelling in which nothing below a dropped element is kept. Elements without text have no say."""
        n = len(self.tag)
        p = np.clip(p, 1e-4, 1 - 1e-4)
        has = np.array(self.chars) > 0
        keep, drop = np.where(has, np.log(p), 0.0).tolist(), np.where(has, np.log(1 - p), 0.0).tolist()
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            keep[up] += keep[k] if self._goes_along(k) else max(keep[k], drop[k])
            drop[up] += drop[k]
        kept = np.zeros(n, bool)
        kept[0] = True
        for k in range(1, n):
            kept[k] = kept[self.parent[k]] and not self.hidden[k] and (keep[k] >= drop[k] or self._goes_along(k))
        return kept

    def _goes_along(self, k: int) -> bool:
        """A phrase element without a mark of its own beside text of its parent; a link too, inside a paragraph, heading, item or cell."""
        up = self.parent[k]
        if self.mask[k] or not self.own[up]:
            return False
        return self.tag[k] in PHRASE or self.tag[k] == "a" and TAG_ALIAS.get(self.tag[up], self.tag[up]) in LINE_TAGS

    def densest(self) -> np.ndarray:
        """The smallest element with half of the text outside links and marked parts, without the marked parts; nothing if there is too little."""
        n = len(self.tag)
        free = [not self.hidden[0]] + [False] * (n - 1)
        for k in range(1, n):
            free[k] = free[self.parent[k]] and not self.hidden[k] and not self.mask[k] & OTHER
        plain = [size if free[k] and not self.in_link[k] else 0 for k, size in enumerate(self.own)]
        for k in range(n - 1, 0, -1):
            plain[self.parent[k]] += plain[k]
        kept = np.zeros(n, bool)
        if plain[0] < FALLBACK_CHARS:
            return kept
        top = max(k for k in range(n) if 2 * plain[k] >= plain[0])
        while top and self.tag[top] not in BLOCK:
            top = self.parent[top]
        kept[top] = True
        for k in range(top + 1, n):  # boxes that are mostly links are menus
            kept[k] = kept[self.parent[k]] and free[k] and (plain[k] * 2 >= self.chars[k] or self.tag[k] == "a" and self.own[self.parent[k]] > 0)
        return kept

    def text(self, kept: np.ndarray) -> str:
        blocks, now = [], []
        for node, chunk in self.items:
            if chunk is None:
                if now:
                    blocks.append("".join(now))
                    now = []
            elif kept[node]:
                now.append(chunk)
        blocks.append("".join(now))
        return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def landmark_labels(page: Page) -> np.ndarray | None:
    """1 for elements in (or around) an article or main landmark and in no other landmark; None for pages without one."""
    n = len(page.tag)
    bad = ~np.int64(1) & ((1 << len(GROUPS)) - 1)
    zone = [False] * n
    for k in range(1, n):
        own = page.tag[k] in ("article", "main")
        zone[k] = (own or zone[page.parent[k]]) and not page.mask[k] & bad
    if not any(zone):
        return None
    out = np.array(zone)
    for k in range(n - 1, 0, -1):
        out[page.parent[k]] |= out[k]
    return out.astype(np.float64)


def fit(pages: list[tuple[Page, np.ndarray]]) -> BoostedTrees:
    """Trees from pages with a label for every element."""
    xs, ys = [], []
    for page, label in pages:
        x = page.features()
        use = np.flatnonzero((np.array(page.chars) > 0) & ~np.array(page.hidden))
        use = use[use > 0]
        xs.append(x[use])
        ys.append(label[use])
    return BoostedTrees().fit(np.concatenate(xs), np.concatenate(ys))


def extract_texts(htmls: list[str | None], model: BoostedTrees) -> list[str]:
    pages = [Page(h or "") for h in htmls]
    xs = [p.features() for p in pages]
    if not xs:
        return []
    p = model.predict(np.concatenate(xs))
    out, at = [], 0
    for page, x in zip(pages, xs):
        out.append(page.text(page.decode(p[at:at + len(x)])) or page.text(page.densest()))
        at += len(x)
    return out


def trained(pages: DataFrame, html_col: str, train_pages: int, layouts: int) -> BoostedTrees:
    from memweave.llm.training import layouts as laid_out

    html = F.col(f"`{html_col}`")
    usable = pages.select(html.alias("h")).filter(html.isNotNull() & (F.length(html) <= TRAIN_CHARS))
    # equal pages count once, so there are train_pages of them at most
    sample = first_by_hash(usable, F.col("h"), train_pages).groupBy(F.xxhash64("h").alias("k")).agg(F.min("h").alias("h"))
    own = []
    for r in sorted(sample.collect()):
        page = Page(r["h"])
        label = landmark_labels(page)
        if label is not None:
            own.append((page, label))
    return fit(laid_out(layouts) + own)


def extract_main_text(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None, *, train_pages: int = 150, layouts: int = 600,
                      text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Columns ``keep`` (default: all but the html) plus ``text`` and ``n_chars``; no shuffle."""
    keep = [c for c in pages.columns if c not in (html_col, text, n_chars)] if keep is None else keep
    model = pages.sparkSession.sparkContext.broadcast(trained(pages, html_col, train_pages, layouts))
    kept = pages.select(*[F.col(f"`{c}`") for c in keep])
    schema = StructType([*kept.schema.fields, StructField(text, StringType()), StructField(n_chars, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                texts = extract_texts(part.column(part.num_columns - 1).to_pylist(), model.value)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                                 names=schema.names)

    return pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_col}`").alias("_html")).mapInArrow(run, schema)
