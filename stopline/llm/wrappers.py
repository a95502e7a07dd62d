"""Wrappers: union-free regular expressions inferred per host, and the main text they single out.

A page is read as a stream of block tags and text. Tags without an end tag are closed where HTML
closes them, so the stream nests. Its own repeats are folded first: neighbours with
the same tag become one repeated group, and where they differ inside, what only some
have becomes optional. The folded stream, the page's shape, carries no text, so a host
has few of them. Shapes of one host are then aligned, two by two: tags that agree stay,
a tag only one side has becomes an optional group, a group either side repeats becomes
a repeated one. Shapes are merged in rounds of at most `FAN` at a time until a host has one wrapper, so no
task gathers a host. Text slots whose text is the same on every page are fixed text,
the others are fields.

Main text: the fields and texts under the wrapper's `article` nodes (`main`, or role=main, if there is
none), outside boilerplate (tags, roles and class words of menus, sidebars, forms,
notices, adverts, comments). A wrapper with neither takes the body's slots that are no boilerplate, no fixed
text, and not mostly links. Each page's shape is aligned with its host's wrapper to tell which of
its slots are main text, and the page is read again with that.

Defined results. Null html is empty text. A null url, or one without `://`, has the host ''. Tags broken off,
stray `<` and unknown references are text as they stand. Elements nested deeper than `DEEPEST` count as parts of
the one at that depth, but still end a line. A host with one page has the page's shape as its wrapper, and
no fixed text. Repeated rows are read alike. Pages of any length are read whole. `main_text` keeps
all columns and raises ValueError if one has the name of its result.
"""

from __future__ import annotations

import html as references
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopline.llm.common import store
from stopline.session import broadcast_if_small

FAN = 100
SEEN_ON = 3          # pages that must agree before a text counts as fixed
LINK_SHARE = 0.5
DEEPEST = 150        # nesting that is told apart
HELD = 20_000        # (host, shape) counts a task holds before it sends them on

# ---- fixed values: HTML's block elements, implied ends, and names of boilerplate ----
BLOCKS = frozenset("""address article aside blockquote body button canvas caption center dd details dialog dir div dl dt
fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu
nav noscript object ol optgroup option p pre search section select summary svg table tbody td template textarea tfoot th
thead title tr ul video audio script style""".split())
VOID = frozenset(["hr"])
RAW = frozenset(["script", "style", "textarea", "title", "iframe", "noscript"])
# an open element of the key ends when one of these starts beside it
ENDS = {
    "p": BLOCKS - {"button", "canvas", "object", "svg", "video", "audio", "iframe", "noscript", "script", "style", "template"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
    "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"},
    "tr": {"tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"}, "head": {"body"},
}
# an end tag does not close elements beyond one of these
WALLS = {"p": {"article", "body", "div", "section", "main", "aside", "nav", "header", "footer", "form", "blockquote", "li", "td"},
         "li": {"ul", "ol", "menu"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}}
BOILER_TAGS = frozenset("""aside button canvas dialog footer form head iframe menu nav noscript object script search select
style svg template textarea title video audio""".split())
BOILER_ROLES = frozenset("""alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search
status toolbar""".split())
BOILER_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments
consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice
notices notification pagination paywall popup promo promotion related responses share sharing sidebar signup skip
social sponsor sponsored subscribe subscription toolbar widget""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>
    |<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>""", re.S | re.X)
_NAMED = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.I)
_DIGITS = re.compile(r"\d+")


def label_of(name: str, attributes: str) -> str:
    """The tag with its class, id and role words; digits in them count alike."""
    words = {}
    if attributes:
        for key, *values in _NAMED.findall(" " + attributes.strip()):
            words.setdefault(key.lower(), next((v for v in values if v), "").lower())
    hidden = "hidden" in words or words.get("aria-hidden") == "true"
    parts = [name] + ["." + x for x in sorted(_DIGITS.sub("0", words.get("class", "")).split())]
    parts += ["#" + x for x in _DIGITS.sub("0", words.get("id", "")).split()]
    parts += ["@" + words["role"]] if words.get("role") else []
    return " ".join(parts + ["!hidden"] * hidden)


class Node:
    """An element of a page: its label, its children, and the pieces of text right inside it."""
    __slots__ = ("label", "name", "children", "texts", "links", "slot")

    def __init__(self, label: str, name: str):
        self.label, self.name = label, name
        self.children: list[Node] = []
        self.texts: list[str] = []
        self.links = 0
        self.slot = -1


def read_page(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The page's tree of blocks, and its runs of text in page order with the node they are in."""
    root = Node("#page", "#page")
    stack, runs, buffer, in_link, at, below = [root], [], [], 0, 0, 0

    def flush():
        nonlocal buffer
        text = " ".join(references.unescape("".join(buffer)).split()) if buffer else ""
        buffer = []
        if text:
            node = stack[-1]
            node.texts.append(text)
            runs.append((node, text))
            if in_link:
                node.links += len(text)

    def close(depth: int):
        nonlocal in_link
        flush()
        in_link = 0
        del stack[depth:]

    end = len(page)
    while True:
        m = _TAG.search(page, at)
        buffer.append(page[at:m.start()] if m else page[at:end])
        if m is None:
            break
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            continue
        name = name.lower()
        closing = bool(m.group(1) or m.group(4))
        if name not in BLOCKS:
            if name == "br":
                buffer.append(" ")
            elif name == "a":
                # the text of a link counts as such where it is a block's whole run
                if not closing and not "".join(buffer).strip():
                    in_link = 1
            continue
        if closing and below:
            below -= 1
            flush()
            continue
        if closing:
            wall = WALLS.get(name, ())
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == name:
                    close(depth)
                    break
                if stack[depth].name in wall:
                    break
            continue
        while len(stack) > 1 and name in ENDS.get(stack[-1].name, ()):
            close(len(stack) - 1)
        if name in ENDS:  # list items and cells end their like, up to their list or table
            wall = WALLS.get(name, ())
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name in wall or name == "p":
                    break
                if name in ENDS.get(stack[depth].name, ()):
                    close(depth)
                    break
        flush()
        in_link = 0
        if len(stack) > DEEPEST and name not in VOID and name not in RAW:
            below += 1
            continue
        node = Node(label_of(name, m.group(3) or m.group(6)), name)
        stack[-1].children.append(node)
        if name in VOID:
            continue
        if name in RAW:
            stop = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            if name not in ("script", "style"):
                text = " ".join(references.unescape(page[at:stop.start() if stop else end]).split())
                if text:
                    node.texts.append(text)
                    runs.append((node, text))
            at = stop.end() if stop else end
            continue
        stack.append(node)
    flush()
    return root, runs


# ---- shapes and wrappers: [label, repeated, optional, children] ----

def aligned(a: list, b: list) -> list[tuple[int | None, int | None]]:
    """The longest common run of labels of two lists of nodes, as pairs of places."""
    n, m = len(a), len(b)
    la, lb = [x[0] for x in a], [x[0] for x in b]
    head = 0
    while head < min(n, m) and la[head] == lb[head]:
        head += 1
    tail = 0
    while tail < min(n, m) - head and la[n - 1 - tail] == lb[m - 1 - tail]:
        tail += 1
    pairs = [(i, i) for i in range(head)]
    p, q = n - head - tail, m - head - tail
    best = np.zeros((p + 1, q + 1), np.int32)
    for i in range(p - 1, -1, -1):
        for j in range(q - 1, -1, -1):
            best[i, j] = (best[i + 1, j + 1] + 1 if la[head + i] == lb[head + j]
                          else max(best[i + 1, j], best[i, j + 1]))
    i = j = 0
    while i < p or j < q:
        if i < p and j < q and la[head + i] == lb[head + j]:
            pairs.append((head + i, head + j))
            i, j = i + 1, j + 1
        elif j >= q or (i < p and best[i + 1, j] >= best[i, j + 1]):
            pairs.append((head + i, None))
            i += 1
        else:
            pairs.append((None, head + j))
            j += 1
    return pairs + [(n - k, m - k) for k in range(tail, 0, -1)]


def optional(node: list) -> list:
    return [node[0], node[1], True, node[3]]


def merged(a: list, b: list) -> list:
    """The least wrapper node of one label that holds both."""
    return [a[0], a[1] or b[1], a[2] or b[2], folded(merged_lists(a[3], b[3]))]


def merged_lists(a: list, b: list) -> list:
    if a == b:
        return a
    return [optional(b[j]) if i is None else optional(a[i]) if j is None else merged(a[i], b[j])
            for i, j in aligned(a, b)]


def folded(nodes: list) -> list:
    """Neighbours of one label made one repeated group; it is optional only if all of them are."""
    out: list = []
    for node in nodes:
        if out and out[-1][0] == node[0]:
            last = out[-1]
            out[-1] = [node[0], True, last[2] and node[2], folded(merged_lists(last[3], node[3]))]
        else:
            out.append(node)
    return out


def shape_of(node: Node) -> list:
    return [node.label, False, False, folded([shape_of(c) for c in node.children])]


def numbered(shape: list) -> list[list]:
    """The nodes of a shape or wrapper in order; a node's number is its slot."""
    out, todo = [], [shape]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(node[3]))
    return out


def place(node: Node, shape: list, slots: dict[int, int]) -> None:
    """Give the page's elements the slots of its shape."""
    node.slot = slots[id(shape)]
    at = -1
    for child in node.children:
        if at < 0 or shape[3][at][0] != child.label:
            at += 1
            while shape[3][at][0] != child.label:
                at += 1
        place(child, shape[3][at], slots)


def slots_of(shape: list) -> dict[int, int]:
    return {id(node): i for i, node in enumerate(numbered(shape))}


def slot_map(shape: list, wrapper: list) -> list[int]:
    """The wrapper's slot for each slot of a shape that it holds: the shape is matched as by a regular expression."""
    mine, theirs = slots_of(shape), slots_of(wrapper)
    known: dict = {}

    def fits(a, b) -> bool:
        if a[0] != b[0] or a[1] > b[1] or a[2] > b[2]:
            return False
        key = id(a), id(b)
        if key not in known:
            known[key] = ways(a[3], b[3])
        return known[key][0][0]

    def ways(a, b) -> list[list[bool]]:
        """[i][j]: whether a[i:] is matched by b[j:]."""
        can = [[False] * (len(b) + 1) for _ in range(len(a) + 1)]
        can[-1][-1] = True
        for j in range(len(b) - 1, -1, -1):
            for i in range(len(a), -1, -1):
                can[i][j] = (b[j][2] and can[i][j + 1]) or (
                    i < len(a) and can[i + 1][j + 1] and fits(a[i], b[j]))
        return can

    if not fits(shape, wrapper):
        raise ValueError("the wrapper does not hold the shape")
    out = [0] * len(mine)

    def go(a, b):
        out[mine[id(a)]] = theirs[id(b)]
        can, i, j = known[id(a), id(b)], 0, 0
        while i < len(a[3]):
            if can[i + 1][j + 1] and fits(a[3][i], b[3][j]):
                go(a[3][i], b[3][j])
                i += 1
            j += 1
    go(shape, wrapper)
    return out


def expression(node: list) -> str:
    """A wrapper as a regular expression over tags, # for a text slot."""
    body = "".join(expression(c) for c in node[3])
    tag = node[0].replace(" ", "")
    mark = "*" if node[1] and node[2] else "+" if node[1] else "?" if node[2] else ""
    inside = f"<{tag}>#{body}</>"
    return f"({inside}){mark}" if mark else inside


# ---- which slots are main text ----

def boilerplate(label: str, inside: bool) -> bool:
    name, *marks = label.split(" ")
    if name in BOILER_TAGS or "!hidden" in marks or (name == "header" and not inside):
        return True
    for m in marks:
        if m[0] == "@" and m[1:] in BOILER_ROLES:
            return True
        if m[0] in ".#" and (name not in ("article", "main", "body", "html") or "comment" in m) and any(
                w in BOILER_WORDS and not (inside and w == "header") for w in re.split(r"[-_:0]+", m[1:])):
            return True
    return False


def main_slots(wrapper: list, stats: dict[int, tuple]) -> list[bool]:
    """For each slot of the wrapper whether it is main text; `stats`: slot -> (pages, same, chars, links)."""
    nodes = numbered(wrapper)

    def walk(region):
        at, out = iter(range(len(nodes))), [False] * len(nodes)

        def go(node, inside, gone):
            i = next(at)
            entered = inside or region(node[0])
            gone = gone or boilerplate(node[0], inside)
            out[i] = entered and not gone
            for child in node[3]:
                go(child, entered, gone)
        go(wrapper, False, False)
        return out

    for region in (lambda x: x.split(" ")[0] == "article", lambda x: x.split(" ")[0] == "main" or "@main" in x):
        found = walk(region)
        if any(found[i] and stats.get(i, (0, 0, 0, 0))[2] for i in range(len(nodes))):
            return found
    found = walk(lambda x: x == "#page")
    for i, (pages, same, chars, links) in stats.items():
        found[i] &= not (same and pages >= SEEN_ON) and links <= LINK_SHARE * max(chars, 1)
    return found


# ---- Spark ----

HOST = r"://([^/?#]*)"


def host_of(url) -> F.Column:
    name = F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1)
    return F.translate(name, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def placed_page(page: str | None):
    """(runs of text with their slots known, the shape as text, number of slots)."""
    root, runs = read_page(page or "")
    shape = shape_of(root)
    place(root, shape, slots_of(shape))
    return root, runs, shape


# per host, shape and slot: pages, least and greatest hash of a page's text there, its characters, those in links
COUNTS = "host string, shape string, slot int, pages long, low long, high long, chars long, links long"


def count_shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict = {}
    names = [x.split()[0] for x in COUNTS.split(", ")]

    def flush():
        rows = [(host, shape, i, *s) for (host, shape), slots in held.items() for i, s in enumerate(slots)]
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
            _, runs, shape = placed_page(page.as_py())
            texts: dict = {}
            for node, text in runs:
                texts.setdefault(node.slot, []).append((node, text))
            key = host, json.dumps(shape, separators=(",", ":"))
            slots = held.get(key)
            if slots is None:
                slots = held[key] = [[0, (1 << 63) - 1, -1 << 63, 0, 0] for _ in numbered(shape)]
            for i, s in enumerate(slots):
                here = texts.get(i, ())
                h = xxhash.xxh64_intdigest("\n".join(t for _, t in here)) - (1 << 63)
                s[0], s[1], s[2] = s[0] + 1, min(s[1], h), max(s[2], h)
                s[3] += sum(len(t) for _, t in here)
                s[4] += sum({id(n): n.links for n, _ in here}.values())
            if len(held) >= HELD:
                yield flush()
                held.clear()
    if held:
        yield flush()


def merge_shapes(rows: pd.DataFrame) -> pd.DataFrame:
    wrapper = None
    for shape in sorted(rows.wrapper):
        shape = json.loads(shape)
        wrapper = shape if wrapper is None else merged(wrapper, shape)
    return pd.DataFrame({"host": rows.host.iloc[:1], "wrapper": [json.dumps(wrapper, separators=(",", ":"))]})


def shape_counts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """What `COUNTS` names, over all pages."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html)).mapInArrow(count_shapes, COUNTS)
    return rows.groupBy("host", "shape", "slot").agg(
        F.sum("pages").alias("pages"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links"))


def wrappers(counts: DataFrame, fan: int = FAN) -> DataFrame:
    """(host, wrapper) from the result of `shape_counts`: all shapes of a host merged, at most about `fan` in a task."""
    now = counts.where("slot = 0").select("host", F.col("shape").alias("wrapper"))
    while True:
        now = store(now, "wrappers")
        sizes = now.groupBy("host").count().where("count > 1")
        if not sizes.head(1):
            return now
        parts = store(sizes.select("host", F.ceil(F.col("count") / fan).cast("int").alias("parts")), "host-parts")
        # a host in several parts gets the parts' wrappers, and another round; the parts have two shapes at least
        dealt = now.join(broadcast_if_small(parts), "host", "left").select(
            "host", "wrapper", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("wrapper"), F.col("parts"))).otherwise(
                F.lit(0)).alias("part"), F.coalesce("parts", F.lit(0)).alias("parts"))
        alone = dealt.where("parts = 0").select("host", "wrapper")
        now = alone.unionByName(dealt.where("parts > 0").groupBy("host", "part").applyInPandas(
            merge_shapes, "host string, wrapper string"))


def aligned_shapes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        parsed = {w: json.loads(w) for w in rows.wrapper.unique()}
        yield pd.DataFrame({"host": rows.host, "shape": rows["shape"], "places": [
            slot_map(json.loads(s), parsed[w]) for s, w in zip(rows["shape"], rows.wrapper)]})


def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        yield pd.DataFrame({"host": rows.host, "main": [
            main_slots(json.loads(w), {s["place"]: (s["pages"], s["same"], s["chars"], s["links"]) for s in stats})
            for w, stats in zip(rows.wrapper, rows.stats)]})


def shape_masks(counts: DataFrame, fan: int = FAN) -> DataFrame:
    """(host, shape, mask): for every slot of every shape whether its text is main text."""
    found = wrappers(counts, fan)
    shapes = counts.where("slot = 0").select("host", "shape")
    places = store(shapes.join(broadcast_if_small(found), "host").select("host", "shape", "wrapper").mapInPandas(
        aligned_shapes, "host string, shape string, places array<int>"), "shape-places")
    mapped = counts.join(places, ["host", "shape"]).select(
        "host", F.get("places", F.col("slot")).alias("place"), "pages", "low", "high", "chars", "links")
    stats = mapped.groupBy("host", "place").agg(
        F.sum("pages").alias("pages"), (F.min("low") == F.max("high")).alias("same"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links"))
    stats = stats.groupBy("host").agg(F.collect_list(F.struct("place", "pages", "same", "chars", "links")).alias("stats"))
    main = store(found.join(stats, "host").mapInPandas(choose, "host string, main array<boolean>"), "main-slots")
    return places.join(broadcast_if_small(main), "host").select(
        "host", "shape", F.transform("places", lambda p: F.get("main", p)).alias("mask"))


def main_text(pages: DataFrame, url: str = "url", html: str = "html", into: str = "main_text",
              fan: int = FAN) -> DataFrame:
    """`pages` with `into`, the main text: one line a block."""
    if into in pages.columns:
        raise ValueError(f"the pages have a column {into}")
    masks = store(shape_masks(store(shape_counts(pages, url, html), "shape-counts"), fan), "masks")
    keyed = masks.select("host", F.xxhash64("shape").alias("shape"), "mask")
    shaped = _with_shape(pages, url, html)
    names = [F.col(f"p.`{c}`") for c in pages.columns]
    return (shaped.alias("p").join(broadcast_if_small(keyed).alias("m"), [
        F.col(f"p.{_HOST}") == F.col("m.host"), F.col(f"p.{_SHAPE}") == F.col("m.shape")], "left")
        .select(*names, F.concat_ws("\n", F.filter(F.transform(
            f"p.{_RUNS}", lambda r: F.when(F.get("m.mask", r["slot"]), r["text"])), lambda t: t.isNotNull())).alias(into)))


_HOST, _SHAPE, _RUNS = "_wrapper_host", "_wrapper_shape", "_wrapper_runs"


def shaped_batches(html: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shapes, runs = [], []
            for page in batch.column(html):
                _, found, shape = placed_page(page.as_py())
                shape = xxhash.xxh64_intdigest(json.dumps(shape, separators=(",", ":")), 42)  # as Spark hashes it
                shapes.append(shape - (1 << 64) if shape >> 63 else shape)
                runs.append([(node.slot, text) for node, text in found])
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array(shapes, pa.int64()), pa.array(
                    [[{"slot": s, "text": t} for s, t in r] for r in runs],
                    pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())])))],
                [*batch.schema.names, _SHAPE, _RUNS])
    return run


def _with_shape(pages: DataFrame, url: str, html: str) -> DataFrame:
    """`pages` with host, hash of the shape, and runs of text with their slots."""
    if {_HOST, _SHAPE, _RUNS} & set(pages.columns):
        raise ValueError(f"the pages have a column {_HOST}, {_SHAPE} or {_RUNS}")
    step = pages.withColumn(_HOST, host_of(F.col(f"`{url}`")))
    schema = T.StructType([*step.schema.fields, T.StructField(_SHAPE, T.LongType()), T.StructField(
        _RUNS, T.ArrayType(T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("text", T.StringType())])))])
    return step.mapInArrow(shaped_batches(html), schema)


def text_rows(pages: DataFrame) -> DataFrame:
    """One row per page: its main text and that text's code points."""
    rows = main_text(pages.select("page_id", "url", "html"))
    return rows.select("page_id", "url", F.col("main_text").alias("text"),
                       F.length("main_text").cast("long").alias("n_chars"))
