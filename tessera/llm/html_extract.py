"""Main text of web pages by wrappers: union-free regular expressions.

1. Every page becomes its token stream of block tags and text slots, folded
   into a union-free expression: adjacent equal groups become one repeated
   group ``(...)+``. A slot knows the parts its ancestors play and, unless these
   already decide about it, the hashes of its texts.
2. Per host the distinct expressions are counted and aligned into a wrapper:
   groups that match are merged, groups only one side has become optional
   ``(...)?``, neighbours that become equal become repeated. A text that two
   expressions have in the same group stays in the wrapper, one that differs
   leaves a slot. Hosts are aligned in a tree of parts of about ``PART``
   expressions, so a host with a third of all pages is never one task's work.
3. The wrapper says where the host's main text is, so that all its pages are
   cut alike: its main element if that holds articles, else its articles, else
   main, else an element named like content, else the body. It also says what
   is template: texts that stand in a group on all pages that have it, three of
   them and half of the host's at least. Texts in an article are never template.
4. A page's main text is the blocks inside that place that are not template
   and not, below the place, in menus, headers, footers, sidebars, notices,
   adverts, forms, comments or hidden elements. A page without that place falls
   back to the other kinds, then to places inside forms and elements whose class
   or id sounds unlike main text; one that consists of template only keeps it.

HTML is read leniently: unclosed and stray tags, unquoted attributes, comments
and raw-text elements cut off by the end of the page. A block ends at every
block tag; inline tags and line breaks do not end it. A class or id speaks for an
element if all parts of one of its names are known words.

Defined results: null or empty html, or a page without main text, gives the
empty string; a null url is a host of its own; repeated pages are treated
alike; in expressions, elements nested deeper than ``DEPTH`` count for their
ancestor at that depth; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import html
import json
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import scratch
from tessera.llm._tokens import slices

PART = 512  # expressions that are aligned one after the other
DEPTH = 64
WIDE = 400  # children beyond which alignment takes matches greedily
CONSTANT_ON = 3  # pages that must share a text of the template

# HTML element kinds.
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp template svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead title tr ul".split()
)
ENDS_P = BLOCK - frozenset("body html head title option optgroup legend".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
# Elements, roles and words in class or id that are not main text,
# words that say content, and words that say neither.
NOT_MAIN = frozenset("head nav header footer aside menu button select dialog option search fieldset".split())
NOT_MAIN_ROLES = frozenset("navigation banner contentinfo complementary dialog alertdialog alert menu".split())
NOT_MAIN_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright "
    "disclaimer disqus footer gdpr header legal masthead menu modal nav navbar navigation newsletter notice notices pagination "
    "popup promo promoted related replies respond response responses share sharing sidebar social sponsor sponsored subscribe "
    "toolbar widget".split()
)
MAIN_WORDS = frozenset("article content entry post story main".split())
NEUTRAL_WORDS = frozenset(
    "site page body text top bottom left right global primary secondary box bar area container wrapper wrap section list block "
    "inner outer item items link links button buttons user reader readers js col column row full wide".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S,
)
_NAMES = re.compile(
    r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?=[\s/]|\Z))", re.I
)
# Fixed marks of the parts that elements play: article, main element, named
# like content; not main text by element or role, by class or id; a form.
ARTICLE, MAIN, NAMED, BODY = "0123"
OUT, WORDED, FORM = "-wf"


def _named_kind(names: str) -> str:
    """What class and id say: WORDED, NAMED or ''."""
    main = out = mixed = False
    for name in names.split():
        parts = set(re.findall(r"[a-z]+", name))
        if not parts or not parts <= NOT_MAIN_WORDS | MAIN_WORDS | NEUTRAL_WORDS:
            continue
        unlike, like = parts & NOT_MAIN_WORDS, parts & (MAIN_WORDS - {"main"})
        mixed = mixed or bool(unlike and like)
        out = out or bool(unlike and not like)
        main = main or bool(not unlike and parts & MAIN_WORDS)
    return WORDED if out or (mixed and not main) else NAMED if main else ""


def _kind(tag: str, attrs: str) -> str:
    """The part an element plays, or ''."""
    if tag == "form":
        return FORM
    if tag in NOT_MAIN:
        return OUT
    names: dict[str, str] = {}
    for m in _NAMES.finditer(attrs) if attrs else ():
        names.setdefault(m[1].lower(), (m[2] or m[3] or m[4] or "").lower())
    if not names:
        return ARTICLE if tag == "article" else MAIN if tag == "main" else ""
    role, style = names.get("role", ""), names.get("style", "").replace(" ", "")
    if "hidden" in names or names.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return OUT
    if role in NOT_MAIN_ROLES:
        return OUT
    if role in ("search", "form"):
        return FORM
    if tag == "article" or role == "article":
        return ARTICLE
    if tag == "main" or role == "main":
        return MAIN
    return "" if tag in ("html", "body") else _named_kind(names.get("class", "") + " " + names.get("id", ""))


def blocks(page: str | None) -> list[tuple[tuple[str, ...], tuple[int, ...], str, str]]:
    """(path, elements, text, kinds) of every text block in page order. A path
    holds a label ``tag`` or ``tag:kind`` per open block element, ``elements``
    numbers the elements themselves; both go down to ``DEPTH``. ``kinds`` are
    the parts of all open elements from the outermost, without repeats."""
    out: list[tuple[tuple[str, ...], tuple[int, ...], str, str]] = []
    path: list[str] = []  # labels of the open block elements
    path_tags: list[str] = []
    numbers: list[int] = []
    kinds = [""]  # the parts down to each open element
    text: list[str] = []
    hidden: list[str] = []  # open inline elements from one that is not main text
    n_elements = 0

    def flush():
        words = " ".join(html.unescape("".join(text)).split())
        text.clear()
        hidden.clear()
        if words:
            out.append((tuple(path[:DEPTH]), tuple(numbers[:DEPTH]), words, kinds[-1]))

    def pop_to(i: int):
        flush()
        del path[i:], path_tags[i:], numbers[i:], kinds[i + 1 :]

    def last_open(tags, stop=()) -> int:
        for i in range(len(path_tags) - 1, -1, -1):
            if path_tags[i] in tags:
                return i
            if path_tags[i] in stop:
                return -1
        return -1

    page = page or ""
    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            if not hidden:
                text.append(page[at:])
            break
        if not hidden:
            text.append(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            if m[0].startswith("<![CDATA[") and not hidden:
                text.append(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
            continue
        if m["close"]:
            if tag in BLOCK and tag in path_tags:
                pop_to(len(path_tags) - 1 - path_tags[::-1].index(tag))
            elif tag in BLOCK:
                flush()
            elif tag in hidden:
                del hidden[len(hidden) - 1 - hidden[::-1].index(tag) :]
            continue
        if tag in RAW and not m["attrs"].endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID or tag not in BLOCK:
            if tag == "br":
                text.append(" ")
            elif tag in BLOCK:
                flush()
            elif tag not in VOID and not m["attrs"].endswith("/") and (hidden or (m["attrs"] and _kind(tag, m["attrs"]) in (OUT, WORDED))):
                hidden.append(tag)
            continue
        if tag in ("html", "body") and tag in path_tags:
            continue
        flush()
        if tag == "body" or (tag in BLOCK and tag not in NOT_MAIN and "head" in path_tags):
            i = last_open({"head"})
            if i >= 0:
                pop_to(i)
        if tag in ENDS_P:
            i = last_open({"p"}, BLOCK - {"p"})
            if i >= 0:
                pop_to(i)
        if tag in SIBLINGS:
            i = last_open(SIBLINGS[tag], {"ul", "ol", "dl", "table", "select", "menu"})
            if i >= 0:
                pop_to(i)
        kind = _kind(tag, m["attrs"])
        path.append(f"{tag}:{kind}" if kind else tag)
        path_tags.append(tag)
        kinds.append(kinds[-1] if kinds[-1].endswith(kind) else kinds[-1] + kind)
        numbers.append(n_elements)
        n_elements += 1
    flush()
    return out


# An expression node is [label, marks, children, pages]; marks holds "+" and
# "?", pages the number of pages that have the node. A slot's label is "#:" and
# the parts of its ancestors, and its children are the hashes of its texts: all
# of a page's, then those that every page has.


def _decided(kinds: str) -> bool:
    """Whether the ancestors alone say if a block is main text."""
    return ARTICLE in kinds or OUT in kinds


def text_hash(path: tuple[str, ...], words: str) -> str:
    return hashlib.blake2b(("/".join(path) + "\n" + words).encode(), digest_size=8).hexdigest()


def expression(found: list[tuple[tuple[str, ...], tuple[int, ...], str, str]]) -> list:
    """Fold the page's slots into one union-free expression."""
    root = ["", "", [], 1]
    open_nodes = [root]
    before: tuple[int, ...] = ()

    def close(n: int):
        while len(open_nodes) > n:
            open_nodes.pop()
            _fold(open_nodes[-1][2])

    for path, numbers, words, kinds in found:
        same = 0
        while same < min(len(numbers), len(before)) and numbers[same] == before[same]:
            same += 1
        close(same + 1)
        for label in path[same:]:
            node = [label, "", [], 1]
            open_nodes[-1][2].append(node)
            open_nodes.append(node)
        open_nodes[-1][2].append([f"#:{kinds}", "", [] if _decided(kinds) else [text_hash(path, words)], 1])
        _fold(open_nodes[-1][2])
        before = numbers
    close(1)
    return root


def _fold(children: list) -> None:
    """Merge the last two children if they have the same label."""
    while len(children) > 1 and children[-1][0] == children[-2][0]:
        last = children.pop()
        merged = align(children[-1], last, folding=True)
        merged[1] = "".join(sorted(set(merged[1]) | {"+"}))
        children[-1] = merged


def align(a: list, b: list, folding: bool = False) -> list:
    """The union-free expression of both: mismatching groups become optional,
    mismatching texts leave a slot. ``folding``: neighbours of one expression,
    whose texts are put together."""
    marks = set(a[1]) | set(b[1])
    pages = max(a[3], b[3]) if folding else a[3] + b[3]
    x, y = a[2], b[2]
    if a[0].startswith("#"):
        texts = set(x) | set(y) if folding else set(x) & set(y)
        return [a[0], "".join(sorted(marks)), sorted(texts), pages]
    children: list = []

    def put(node, optional):
        if optional:
            node = [node[0], "".join(sorted(set(node[1]) | {"?"})), node[2], node[3]]
        children.append(node)
        _fold(children)

    i = j = 0
    for p, q in _matches([n[0] for n in x], [n[0] for n in y]):
        for n in x[i:p] + y[j:q]:
            put(n, True)
        put(align(x[p], y[q], folding), False)
        i, j = p + 1, q + 1
    for n in x[i:] + y[j:]:
        put(n, True)
    return [a[0], "".join(sorted(marks)), children, pages]


def _matches(x: list[str], y: list[str]) -> list[tuple[int, int]]:
    """Longest common subsequence of labels as index pairs."""
    if x == y:
        return [(i, i) for i in range(len(x))]
    if len(x) * len(y) > WIDE * WIDE:
        out, at = [], 0
        for i, label in enumerate(x):
            if label in y[at : at + WIDE]:
                at = y.index(label, at) + 1
                out.append((i, at - 1))
        return out
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if x[i] == y[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _inside(kinds: str, rank: str, outside: str = FORM) -> bool:
    """Whether a block lies in a place of that rank with nothing between them
    that is not main text, and around the place only what ``outside`` allows."""
    if rank == BODY:
        return not set(kinds) & set(OUT + WORDED + FORM) - set(outside)
    around, found, within = kinds.rpartition(rank)
    # The outermost place of that rank that is reached counts too.
    return bool(found) and not set(within) & set(OUT + WORDED + FORM) and not set(around) & set(OUT + WORDED + FORM) - set(outside)


def _slots(wrapper: list):
    todo = [wrapper]
    while todo:
        node = todo.pop()
        if node[0].startswith("#"):
            yield node
        else:
            todo += node[2]


def rules(wrapper: list) -> tuple[str, list[str]]:
    """The rank of the host's main place, and the hashes of its template."""
    slots = list(_slots(wrapper))
    kinds = {n[0][2:] for n in slots}
    rank = next((r for r in (ARTICLE, MAIN, NAMED) if any(_inside(k, r) for k in kinds)), BODY)
    if rank == ARTICLE and any(ARTICLE in k.partition(MAIN)[2] and _inside(k, MAIN) for k in kinds):
        rank = MAIN
    template = {t for n in slots if n[3] >= CONSTANT_ON and 2 * n[3] >= wrapper[3] for t in n[2]}
    return rank, sorted(template)


def main_text(found: list[tuple[tuple[str, ...], tuple[int, ...], str, str]], rank: str, template: frozenset = frozenset()) -> str:
    ways = [(r, FORM) for r in rank + "0123".replace(rank, "")]
    ways += [(r, FORM + WORDED) for r in (ARTICLE, MAIN, NAMED)]
    for r, outside in ways:
        # The body itself is no place inside a form, until nothing else is left.
        inside = [b for b in found if _inside(b[3], r, "" if r == BODY else outside)]
        if inside:
            own = [b for b in inside if _decided(b[3]) or text_hash(b[0], b[2]) not in template] if template else inside
            return "\n\n".join(b[2] for b in own or inside)
    return "\n\n".join(b[2] for b in found if _inside(b[3], BODY, FORM))


def _host(url):
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise(F.lit(""))
    return F.coalesce(F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))


def _pages(batch: pa.RecordBatch) -> list:
    return batch.column(batch.schema.get_field_index("html")).to_pylist()


def _expressions(batches):
    for batch in slices(batches, "html"):
        made = [json.dumps(expression(blocks(h)), separators=(",", ":")) for h in _pages(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index("host")), pa.array(made, pa.string())], names=["host", "expression"]
        )


def _weighted(text: str, n: int) -> list:
    """A stored expression with the pages of ``n`` pages like it."""
    node = json.loads(text)
    for part in _nodes(node) if n > 1 else ():
        part[3] *= n
    return node


def _nodes(node: list):
    todo = [node]
    while todo:
        node = todo.pop()
        yield node
        if not node[0].startswith("#"):
            todo += node[2]


def _align_all(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values(["n", "expression"], ascending=[False, True])
    wrapper = None
    for text, n in zip(rows["expression"], rows["n"]):
        node = _weighted(text, int(n))
        wrapper = node if wrapper is None else align(wrapper, node)
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "expression": [json.dumps(wrapper, separators=(",", ":"))], "n": [1]})


def wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """(host, expression, n): the wrapper of every host and its page count."""
    schema = "host string, expression string, n bigint"
    level = scratch(
        pages.select(_host(F.col(url)).alias("host"), F.col(page).alias("html"))
        .mapInArrow(_expressions, "host string, expression string")
        .groupBy("host", "expression")
        .agg(F.count(F.lit(1)).alias("n")),
        "html-expressions",
    )
    while True:
        most = level.groupBy("host").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
        parts = -(-most // PART)
        if parts <= 1:
            whole = level.groupBy("host").applyInPandas(lambda rows: _align_all(rows), schema)
            n = F.get_json_object("expression", "$[3]").cast("long")  # pages of the root
            return scratch(whole.select("host", "expression", n.alias("n")), "html-wrappers")
        part = F.pmod(F.xxhash64("expression"), F.lit(parts))
        level = scratch(level.groupBy("host", part.alias("part")).applyInPandas(lambda rows: _align_all(rows), schema), "html-parts")


def _host_rules(rows):
    for batch in rows:
        hosts, made = batch.column(0), [rules(json.loads(t)) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [hosts, pa.array([r for r, _ in made], pa.string()), pa.array([t for _, t in made], pa.list_(pa.string()))],
            names=["w_host", "rank", "template"],
        )


def _texts(batches):
    for batch in slices(batches, "html"):
        get = {n: batch.column(batch.schema.get_field_index(n)) for n in ("page_id", "url", "rank", "template")}
        out, sets = [], {}
        for h, rank, template in zip(_pages(batch), get["rank"].to_pylist(), get["template"].to_pylist()):
            known = sets.setdefault(tuple(template), frozenset(template))
            out.append(main_text(blocks(h), rank, known))
        yield pa.RecordBatch.from_arrays(
            [get["page_id"], get["url"], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    found = scratch(
        wrappers(pages, url, page).select("host", "expression").mapInArrow(_host_rules, "w_host string, rank string, template array<string>"),
        "html-rules",
    )
    kind = pages.schema[page_id].dataType.simpleString()
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(page).alias("html"), _host(F.col(url)).alias("host")
    )
    return (
        rows.join(found, F.col("host") == F.col("w_host"))
        .select("page_id", "url", "html", "rank", "template")
        .mapInArrow(_texts, f"page_id {kind}, url string, text string, n_chars bigint")
    )


def digest(pages: DataFrame) -> DataFrame:
    return extract(pages)
