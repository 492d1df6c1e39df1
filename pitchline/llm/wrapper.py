"""HTML extraction by wrapper induction.

1. Every page becomes a skeleton: its tree of block elements with a label
   (tag, class, id), a hash of the block's own text and its text and link
   lengths; a few bytes per block.
2. One page of each host, the one with the most kinds of blocks, is the pivot.
   Every page of the host is aligned with it by simple tree matching (the
   largest order-preserving match of equal labels, top down). Tasks add up,
   per pivot block, how often it was found, how often with the same text, and
   how much text and link text stood in it; only these sums are shuffled, so a
   host with a third of all pages is spread over all tasks.
3. A wrapper is the pivot with these sums. Blocks whose text stays the same
   are template. The main slot is the container reached by following the
   block that holds most of the varying text.
4. Every page is aligned once more with its wrapper; the text of its main slot
   without template blocks, menus, forms and the like is the result. Pages
   that do not fit their wrapper (its slot holds less than half of their text
   that is neither template nor apart), and pages of hosts seen once, choose
   the main slot from their own sums.

Pages that share half of their text or more with the pivot (copies) say
nothing about what is template, so copies of an article never turn it into one.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchline.functions.columns import broadcast_if_small
from pitchline.llm.common import bounded_batches, land, row_slices, text_or_empty
from pitchline.llm.url_rules import url_host

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>""", re.S)
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][^\s=/>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
#: Elements whose content is not markup; none of it is article text.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
CONTAINERS = frozenset("html body div main article section center table tbody thead tfoot tr ul ol dl figure "
                       "details hgroup fieldset nav header footer aside form menu dialog noscript template head "
                       "search".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption address summary td th "
                        "legend option select button label".split())
BLOCKS = CONTAINERS | TEXT_BLOCKS
#: Elements that are never article text.
APART = frozenset("head nav footer aside form menu dialog noscript template select button search".split())
#: Words in class, id or role that mark a block as apart from the article.
MARKS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner sidebar nav navbar "
                  "navigation menu menubar breadcrumb breadcrumbs footer cookie cookies consent notice alert popup "
                  "modal overlay newsletter subscribe signup login comment comments reply replies respond discussion "
                  "disqus share sharing social related recommended widget pagination pager toolbar contentinfo "
                  "complementary search hidden".split())
#: What a new block ends when it stands open.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
         "th": {"td", "th"}, "option": {"option"}}
_LISTS = frozenset("ul ol dl table menu".split())
#: Blocks nested deeper become siblings in the tree, as in browsers; no text is lost, and marks of open blocks hold on.
MAX_DEPTH = 200
#: Parts of a class that make it speak about the layout ("l-no-sidebar") and mark nothing. Fixed values.
LAYOUT = frozenset("no not without has with layout l".split())
#: Elements that head a page's article; a page's only one tells which block must not be set apart by its classes.
HEADS = ("article", "main", "h1")


@dataclass
class Page:
    """Blocks in page order. ``runs``: (block, raw text, link characters) between block borders."""
    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    apart: list[bool] = field(default_factory=list)
    runs: list[tuple[int, str, int]] = field(default_factory=list)

    def texts(self) -> list[tuple[int, str, int]]:
        """Runs with decoded references and single spaces, empty ones left out."""
        out = []
        for block, raw, links in self.runs:
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                out.append((block, text, min(links, len(text))))
        return out


def _marked(attributes: str, inside_article: bool, tag: str) -> tuple[str, bool]:
    """(class and id, whether they or the role set the block apart)."""
    if not attributes or attributes.isspace():
        return "", False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    name = f"{found.get('class', '')} {found.get('id', '')}".strip().lower()
    tokens = [set(re.split(r"[^a-z]+", t)) for t in f"{name} {found.get('role', '').lower()}".split()]
    words = set().union(*(t for t in tokens if not t & LAYOUT))
    hidden = "hidden" in found or "display:none" in found.get("style", "").replace(" ", "").lower()
    marked = bool(words & MARKS) or ("header" in words and not inside_article) or hidden
    return name, marked and tag not in ("html", "body", "article", "main")


def parse(text: str) -> Page:
    """Tag soup to blocks: implied ends, unclosed and stray tags, raw elements and cut pages included."""
    page = Page()
    parent, tags, labels, apart = page.parent, page.tag, page.label, page.apart
    parent.append(-1), tags.append(""), labels.append(0), apart.append(False)
    stack, buffer, links, link_depth, pos, end = [0], [], 0, 0, 0, len(text)
    outer, marks, inside, opened = [-1], [0], [False], Counter()  # marks: 1 by class or role, 2 by the element

    def shut(k: int) -> None:
        opened.subtract(tags[b] for b in stack[k:])
        del stack[k:]

    def border():
        nonlocal links
        if buffer:
            page.runs.append((stack[-1], "".join(buffer), links))
            buffer.clear()
        links = 0

    while pos < end:
        m = _TOKEN.search(text, pos)
        piece = text[pos:m.start()] if m else text[pos:]
        if piece:
            buffer.append(piece)
            if link_depth:
                links += len(piece)
        if not m:
            break
        pos = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        if tag in RAW:  # skipped with its content; the text around it stays one run
            if not closing:
                close = re.compile(rf"</{tag}[\s/>]", re.I).search(text, pos)
                pos = close.start() if close else end
            continue
        if tag not in BLOCKS:
            if tag == "a":
                link_depth = 0 if closing else 1
            elif tag in ("br", "hr", "img", "wbr", "input"):
                buffer.append(" ")
            continue
        border()
        link_depth = 0
        if closing:
            for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if tags[stack[k]] == tag:
                    shut(k)
                    break
            continue
        if tag != "option" and "p" in (tags[b] for b in stack[-2:]):  # a block ends an open paragraph
            while tags[stack[-1]] == "p" or (len(stack) > 1 and tags[stack[-2]] == "p"):
                shut(len(stack) - 1)
        if tag in _ENDS:
            for k in range(len(stack) - 1, 0, -1) if any(opened[t] for t in _ENDS[tag]) else ():
                if tags[stack[k]] in _ENDS[tag]:
                    shut(k)
                    break
                if tags[stack[k]] in _LISTS:
                    break
        up = stack[-1]
        name, marked = _marked(m[3] or m[6] or "", inside[up], tag)
        outer.append(up)
        parent.append(stack[min(len(stack), MAX_DEPTH) - 1])
        tags.append(tag)
        labels.append(xxhash.xxh32_intdigest(f"{tag} {name}" if name else tag))
        marks.append(2 if tag in APART or (tag == "header" and not inside[up]) else 1 if marked else 0)
        inside.append(inside[up] or tag in ("article", "main"))
        stack.append(len(tags) - 1)
        opened[tag] += 1
    border()
    _unmark_main(page, outer, marks)
    for k in range(1, len(tags)):
        apart.append(apart[outer[k]] or marks[k] > 0)
    return page


def _unmark_main(page: Page, outer: list[int], marks: list[int]) -> None:
    """Take the marks off blocks whose classes would set the page's main mass apart.

    Such a block holds the page's only article, main or h1 element, and at
    least half of the text that no element sets apart.
    """
    n = len(outer)
    by_element, size = [False] * n, [0] * n
    for k in range(1, n):
        by_element[k] = by_element[outer[k]] or marks[k] == 2
    for block, raw, _ in page.runs:
        if not by_element[block]:
            size[block] += len(raw) - raw.count(" ") - raw.count("\n")
    for k in range(n - 1, 0, -1):
        size[outer[k]] += size[k]
    heads = {tag: [k for k in range(1, n) if page.tag[k] == tag and not by_element[k]] for tag in HEADS}
    for head in (found[0] for found in heads.values() if len(found) == 1):
        while head > 0:
            if marks[head] == 1 and size[head] * 2 >= size[0]:
                marks[head] = 0
            head = outer[head]


def skeleton(page: Page) -> np.ndarray:
    """int64 rows, one per block: parent, label, hash of own text, text length, link length, kind.

    kind: 0 text block, 1 container, 2 apart from the article.
    """
    n = len(page.parent)
    out = np.zeros((n, 6), np.int64)
    out[:, 0], out[:, 1] = page.parent, page.label
    out[:, 5] = [2 if a else 1 if t in CONTAINERS or not t else 0 for a, t in zip(page.apart, page.tag)]
    own: dict[int, list[str]] = {}
    for block, text, links in page.texts():
        own.setdefault(block, []).append(text)
        out[block, 3] += len(text)
        out[block, 4] += links
    for block, texts in own.items():
        out[block, 2] = np.int64(np.uint64(xxhash.xxh64_intdigest("\n".join(texts).encode("utf-8", "replace"))).view(np.int64))
    return out


def _children(parent: list[int]) -> list[list[int]]:
    kids: list[list[int]] = [[] for _ in parent]
    for k in range(1, len(parent)):
        kids[parent[k]].append(k)
    return kids


def align(a_parent: list[int], a_label: list[int], b_parent: list[int], b_label: list[int]) -> dict[int, int]:
    """Simple tree matching of two trees in page order: {block of a: block of b}."""
    ka, kb = _children(a_parent), _children(b_parent)
    tables: dict[tuple[int, int], list[list[int]]] = {}

    def weight(x: int, y: int) -> int:
        """Size of the largest match of two trees whose roots have one label."""
        cx, cy = ka[x], kb[y]
        if not cx or not cy:
            return 1
        kinds = {a_label[c] for c in cx} | {b_label[c] for c in cy}
        if len(kinds) == 1 and not any(ka[c] for c in cx) and not any(kb[c] for c in cy):
            return 1 + min(len(cx), len(cy))  # a run of one kind of leaf: first with first
        rows = [[0] * (len(cy) + 1)]
        labels = [b_label[c] for c in cy]
        for c in cx:
            above, row, label = rows[-1], [0], a_label[c]
            for j, d in enumerate(cy):
                best = above[j + 1] if above[j + 1] >= row[j] else row[j]
                if labels[j] == label and (w := above[j] + weight(c, d)) >= best:
                    best = w
                row.append(best)
            rows.append(row)
        tables[x, y] = rows
        return 1 + rows[-1][-1]

    weights: dict[tuple[int, int], int] = {}
    plain = weight

    def weight(x: int, y: int) -> int:  # noqa: F811  the same, remembered
        w = weights.get((x, y))
        if w is None:
            w = weights[x, y] = plain(x, y)
        return w

    weight(0, 0)
    pairs, todo = {0: 0}, [(0, 0)]
    while todo:
        x, y = todo.pop()
        cx, cy = ka[x], kb[y]
        rows = tables.get((x, y))
        if rows is None:
            found = zip(cx, cy) if cx and cy else ()
        else:
            found, i, j = [], len(cx), len(cy)
            while i and j:
                if a_label[cx[i - 1]] == b_label[cy[j - 1]] and rows[i][j] == rows[i - 1][j - 1] + weights[cx[i - 1], cy[j - 1]]:
                    found.append((cx[i - 1], cy[j - 1]))
                    i, j = i - 1, j - 1
                elif rows[i][j] == rows[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
        for c, d in found:
            pairs[c] = d
            todo.append((c, d))
    return pairs


def observe(page: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    """One page's sums per pivot block: found, compared, same text, text, link text."""
    out = np.zeros((len(pivot), 5), np.int64)
    parent = page[:, 0].tolist()
    pairs = align(parent, page[:, 1].tolist(), pivot[:, 0].tolist(), pivot[:, 1].tolist())
    at = np.zeros(len(page), np.int64)  # the pivot block of each block or of its nearest aligned ancestor
    for k in range(1, len(page)):
        at[k] = pairs.get(k, at[parent[k]])
    mine, theirs = np.array(list(pairs)), np.array(list(pairs.values()))
    same = (page[mine, 2] == pivot[theirs, 2]) & (page[mine, 3] > 0)
    text = np.where(page[:, 5] < 2, page[:, 3], 0)
    out[theirs, 0] = 1
    if text[mine[same]].sum() * 2 < text.sum() or not text.sum():  # not a copy of the pivot
        out[theirs, 1] = 1
        out[theirs[same], 2] = 1
    np.add.at(out[:, 3], at, text)
    np.add.at(out[:, 4], at, np.where(page[:, 5] < 2, page[:, 4], 0))
    return out


#: A block is template if at least this share of this many compared pages has its text.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.9, 5
#: The main slot is followed down while one container holds this share of the varying text.
MAIN_SHARE = 0.8
#: A block is a menu if at least this share of its text is links.
LINK_SHARE = 0.8


def read_wrapper(pivot: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, int]:
    """(whether each pivot block is template or menu, main slot) from the sums over a host's pages."""
    found, compared, same, text, links = sums.T
    drop = (compared >= TEMPLATE_PAGES) & (same >= TEMPLATE_SHARE * compared) & (pivot[:, 3] > 0)
    drop |= (text > 0) & (links >= LINK_SHARE * text) & (found >= TEMPLATE_PAGES)
    mass = np.where(drop, 0, text - links).astype(np.int64)
    parent = pivot[:, 0]
    for k in range(len(pivot) - 1, 0, -1):
        mass[parent[k]] += mass[k]
    main = 0
    while True:
        inner = np.flatnonzero((parent == main) & (pivot[:, 5] == 1))
        inner = inner[mass[inner] >= MAIN_SHARE * max(1, mass[main])]
        if not len(inner):
            return drop, main
        main = int(inner[0])


def extract(page: Page, pivot: np.ndarray | None, sums: np.ndarray | None) -> str:
    """Main text of a page under its host's wrapper, or under its own where that does not fit.

    A wrapper does not fit if its slot holds less than half of the page's text that is neither template nor apart.
    """
    parent, own = page.parent, skeleton(page)
    drop, main = set(), None
    if pivot is not None:
        constant, slot = read_wrapper(pivot, sums)
        pairs = align(parent, page.label, pivot[:, 0].tolist(), pivot[:, 1].tolist())
        back = {d: c for c, d in pairs.items()}
        main = back.get(slot)
        drop = {c for c, d in pairs.items() if constant[d] and (
            own[c, 2] == pivot[d, 2] or own[c, 4] >= LINK_SHARE * own[c, 3])}
    inside = [False] * len(parent)

    def enter(slot: int) -> None:
        for k in range(len(parent)):
            inside[k] = k == slot or (k > 0 and inside[parent[k]])

    fits = False
    if main is not None:
        enter(main)
        varying = [0 if page.apart[k] or k in drop else int(own[k, 3] - own[k, 4]) for k in range(len(parent))]
        held = sum(x for x, there in zip(varying, inside) if there)
        fits = held * 2 >= sum(varying)

    def collect() -> list[str]:
        return [text for block, text, _ in page.texts()
                if inside[block] and not page.apart[block] and block not in drop]

    blocks = collect() if fits else []
    if not blocks:
        mine = observe(own, own)
        mine[list(drop), 3:] = 0
        _, slot = read_wrapper(own, mine)
        enter(slot)
        blocks = collect()
    return "\n".join(blocks)


def _skeletons(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in row_slices(batches):
        trees = [skeleton(parse(h)) for h in batch.column(1).to_pylist()]
        kinds = pa.array([len(set(t[:, 1].tolist())) for t in trees], pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([t.tobytes() for t in trees], pa.binary()), kinds,
             pa.array([len(t) for t in trees], pa.int32())], ["host", "tree", "kinds", "blocks"])


def _sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, tree, pivot) -> partial sums per (host, block), added up in the task."""
    held: dict[str, np.ndarray] = {}
    size = 0

    def flush() -> pa.RecordBatch:
        hosts = [h for h, s in held.items() for _ in range(len(s))]
        blocks = np.concatenate([np.arange(len(s)) for s in held.values()])
        all_sums = np.concatenate(list(held.values()))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(blocks, pa.int32()),
                                           *[pa.array(all_sums[:, k], pa.int64()) for k in range(5)]],
                                          ["host", "block", "found", "compared", "same", "text", "links"])

    for batch in batches:
        for host, tree, pivot in zip(*(batch.column(k).to_pylist() for k in range(3))):
            seen = observe(np.frombuffer(tree, np.int64).reshape(-1, 6), np.frombuffer(pivot, np.int64).reshape(-1, 6))
            if host in held:
                held[host] += seen
            else:
                held[host] = seen
                size += len(seen)
        if size > 200_000:
            yield flush()
            size = 0
    if held:
        yield flush()


def induce(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, pivot, sums): the wrapper of every host with at least two pages, from all of its pages."""
    rows = pages.select(url_host(F.col(url_col).cast("string")).alias("host"), text_or_empty(html_col).alias("html"))
    trees = land(bounded_batches(rows).where("host != ''").mapInArrow(_skeletons, "host string, tree binary, kinds int, blocks int"),
                 "wrapper-skeletons")
    rank = F.struct((-F.col("kinds")).alias("kinds"), "blocks", F.xxhash64("tree").alias("h"))
    best = trees.groupBy("host").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    pivots = (trees.withColumn("rank", rank).alias("t")
              .join(best, (F.col("t.host") == best["host"]) & (F.col("rank") == F.col("best")))
              .select(F.col("t.host").alias("host"), F.col("tree").alias("pivot")).dropDuplicates(["host"]))
    pivots = land(pivots, "wrapper-pivots")
    seen = trees.select("host", "tree").join(broadcast_if_small(pivots), "host").select("host", "tree", "pivot")
    sums = (seen.mapInArrow(_sums, "host string, block int, found long, compared long, same long, text long, links long")
            .groupBy("host", "block").agg(*[F.sum(c).alias(c) for c in ("found", "compared", "same", "text", "links")]))
    lists = sums.groupBy("host").agg(F.array_sort(F.collect_list(
        F.struct("block", "found", "compared", "same", "text", "links"))).alias("sums"))  # one row per pivot block
    return land(pivots.join(lists, "host"), "wrappers")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """One row per input row: id, url, text, n_chars.

    NULL or empty html gives the empty text. Pages with a NULL url or no host
    are extracted by their own sums. Repeated rows are extracted alike and
    all returned; other columns are ignored; an empty table gives an empty
    result.
    """
    wrappers = induce(pages, url_col, html_col).withColumnRenamed("host", "wrapper_host")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                        url_host(F.col(url_col).cast("string")).alias("host"), text_or_empty(html_col).alias("html"))
    fields = ("found", "compared", "same", "text", "links")
    joined = (rows.join(broadcast_if_small(wrappers), F.col("host") == F.col("wrapper_host"), "left")
              .select("id", "url", "html", "pivot",
                      F.flatten(F.transform("sums", lambda s: F.array(*[s[f] for f in fields]))).alias("sums")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in row_slices(batches):
            texts = []
            for html, pivot, sums in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
                tree = None if pivot is None else np.frombuffer(pivot, np.int64).reshape(-1, 6)
                counts = None if pivot is None else sums.values.to_numpy().reshape(-1, 5)
                texts.append(extract(parse(html), tree, counts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             ["id", "url", "text"])

    kinds = rows.schema
    out = bounded_batches(joined).mapInArrow(run, f"id {kinds['id'].dataType.simpleString()}, "
                                 f"url {kinds['url'].dataType.simpleString()}, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                      F.length("text").cast("long").alias("n_chars"))
