"""Main text of web pages by tag-path ratios.

Method. A page's text nodes are grouped by their root-to-leaf tag path. Per path, the text length and the number of
punctuation marks are summed and divided by the number of nodes (the path's ratios); their product, damped by square roots, is
the fused value of each of its nodes. The values are smoothed over the page's node sequence by a Gaussian, and nodes
of paths whose best smoothed value reaches a share of the page's spread become content. The smallest element that holds nearly
all content text is the article: its remaining nodes (headings, short paragraphs, list items) belong to the text too.

Before that, elements that are never article text are left out: scripts, styles, forms and the like, page menus, headers, footers
and sidebars by tag or role, and boxes whose class or id names them as advert, notice, comment section and so on.

Text. Character references are decoded, white space inside a block becomes one space, blocks are trimmed and joined in
page order by one space. A line break counts as white space.

Defined cases. Null html: empty text. Pages without content: empty text. Unclosed and stray tags are closed as browsers
do for paragraphs, list items and table cells; a comment, script or tag that never ends takes the rest. Null ids and
repeated rows are kept. An empty table gives an empty table. Only the named columns are read, so further columns cannot
clash.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARE = 0.25
HOLDS = 0.9
KERNEL = [math.exp(-k * k / 2) for k in range(-2, 3)]

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_PUNCT = re.compile(r"[.,;:!?…。、，！？]")
_NAME = re.compile(r"[a-z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select")}
NEVER = frozenset("head nav footer aside form button label fieldset dialog menu object audio video canvas".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby s samp small span strike strong sub sup time tt u var".split())
ROLES = frozenset("navigation banner complementary contentinfo search menu menubar dialog alert form".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus footer"
    " gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promotion promoted related"
    " recommended reply replies respond share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
HOLDERS = frozenset("article body center div fieldset html main section table tbody td".split())
_ENDS_P = frozenset("address article aside blockquote center details dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_FENCE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}


def _left_out(tag: str, attrs: str, in_article: bool) -> bool:
    if tag in NEVER or (tag == "header" and not in_article):
        return True
    if attrs and tag not in ("html", "body", "article", "main"):
        for m in _ATTR.finditer(attrs):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                return True
            if name == "role" and value in ROLES:
                return True
            if name in ("class", "id") and not NAMES.isdisjoint(_NAME.findall(value)):
                return True
    return False


def nodes(page: str):
    """Text nodes in page order: (path number, element chain, block number, text); and the elements' tags.

    Left-out elements give no nodes. Line breaks are nodes of path -2.
    """
    stack: list[tuple[str, int, int, bool]] = []  # tag, path, element, left out
    paths: dict[tuple[int, str], int] = {}
    tags: list[str] = []
    out, at, block, article, gone = [], 0, 0, 0, 0

    def pop():
        nonlocal block, article, gone
        tag, _, _, left = stack.pop()
        gone -= left
        article -= tag in ("article", "main")
        if tag not in INLINE:
            block += 1

    def text(s):
        if s and not gone and not s.isspace():
            out.append((stack[-1][1] if stack else -1, tuple(x[2] for x in stack), block, entities.unescape(s) if "&" in s else s))
        elif s and not gone and out:
            out.append((-2, (), block, " "))

    size = len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if not tag:
            continue
        tag = tag.lower()
        if m[1]:
            if any(x[0] == tag for x in stack):
                while stack[-1][0] != tag:
                    pop()
                pop()
            continue
        if tag in RAW:
            end = RAW[tag].search(page, at)
            at = end.end() if end else size
            block += tag not in INLINE
            continue
        if tag in VOID:
            if tag == "br":
                if not gone:
                    out.append((-2, (), block, " "))
            elif tag == "hr":
                block += 1
            continue
        if tag in _ENDS_P and any(x[0] == "p" for x in stack):
            while any(x[0] == "p" for x in stack):
                pop()
        if tag in _SAME:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in _SAME[tag]:
                    while len(stack) > k:
                        pop()
                elif stack[k][0] in _FENCE[tag]:
                    break
        left = _left_out(tag, m[3], article > 0)
        parent = stack[-1][1] if stack else -1
        if m[0].endswith("/>") and tag in ("svg", "path"):
            continue
        stack.append((tag, paths.setdefault((parent, tag), len(paths)), len(tags), left))
        tags.append(tag)
        gone += left
        article += tag in ("article", "main")
        if tag not in INLINE:
            block += 1
    return out, tags


def main_text(page: str) -> str:
    all_nodes, tags = nodes(page)
    if not all_nodes:
        return ""
    length: dict[int, float] = {}
    marks: dict[int, float] = {}
    count: dict[int, int] = {}
    for p, _, _, t in all_nodes:
        if p >= -1:
            length[p] = length.get(p, 0) + len(t)
            marks[p] = marks.get(p, 0) + len(_PUNCT.findall(t))
            count[p] = count.get(p, 0) + 1
    if not count:
        return ""
    fused = {p: math.sqrt(length[p] / n) * math.sqrt(0.1 + marks[p] / n) for p, n in count.items()}
    real = [(p, c) for p, c, _, _ in all_nodes if p >= -1]
    value = [fused[p] for p, _ in real]
    smooth = []
    for i in range(len(value)):
        w = [(KERNEL[k + 2], value[i + k]) for k in range(-2, 3) if 0 <= i + k < len(value)]
        smooth.append(sum(a * b for a, b in w) / sum(a for a, _ in w))
    best: dict[int, float] = {}
    for (p, _), s in zip(real, smooth, strict=True):
        best[p] = max(best.get(p, 0.0), s * (0.5 + 0.5 * fused[p] / max(fused.values())))
    top = max(best.values())
    chosen = {p for p, b in best.items() if b >= SHARE * top}
    # the smallest element that holds nearly all chosen text
    weight: dict[int, float] = {}
    depth: dict[int, int] = {}
    total = 0.0
    for p, chain, _, t in all_nodes:
        if p in chosen:
            total += len(t)
            for d, e in enumerate(chain):
                weight[e] = weight.get(e, 0) + len(t)
                depth[e] = d
    held = [e for e, w in weight.items() if w >= HOLDS * total and tags[e] in HOLDERS]
    inside = max(held, key=lambda e: depth[e]) if held else None
    marked = [e for e in held if tags[e] in ("article", "main")]
    if marked:  # the page itself says where the article is
        inside = max(marked, key=lambda e: depth[e])
    blocks: list[str] = []
    last = None
    for p, chain, b, t in all_nodes:
        if p == -2 or inside is None or inside in chain:
            if b != last:
                blocks.append("")
                last = b
            blocks[-1] += t
    return " ".join(" ".join(blocks).split())


def _extract(batches):
    for batch in batches:
        for lo in range(0, batch.num_rows, 128):
            part = batch.slice(lo, 128)
            texts = [main_text(x.as_py() or "") for x in part.column(2)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["p", "u", "text", "n_chars"])


def page_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Returns (page_id, url, text, n_chars) for each page."""
    rows = pages.select(F.col(id_col).cast("long").alias("p"), F.col(url_col).cast("string").alias("u"), F.col(html_col).cast("string").alias("h"))
    return rows.mapInArrow(_extract, "p long, u string, text string, n_chars long").withColumnsRenamed({"p": id_col, "u": url_col})


def op4_page_text(spark, sf_dir):
    """Registered query: the whole table pages."""
    return page_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


_DECODED = "x"
for _name, _char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("nbsp", " "), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    _DECODED = f"replace({_DECODED}, '&{_name};', '{_char}')"
OP4_SQL = f"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article[^>]*>(.*)</article>', 1, 's') AS x FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(x, '</?(p|h[1-6]|br|div|li|ul|ol|section)(\\s[^>]*)?/?>', ' ', 'g'), '<[^>]*>', '', 'g') AS x FROM a),
c AS (SELECT page_id, url, trim(regexp_replace({_DECODED}, '\\s+', ' ', 'g')) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c
"""
