"""Main text of pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of block tags and texts. Pages of a host are aligned one after the other with
the host's wrapper: what repeats side by side becomes a repeated group, what one of them lacks
becomes optional, and texts that differ become slots. Wrappers of parts of a host are aligned with
each other in the same way, so that a host may be spread over any number of tasks. Texts that stay
the same at the same place in all pages of a host belong to its frame and not to the article.
"""

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.common import saved, small_side, table

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

# Names with a fixed meaning in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe object svg math xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins del kbd label mark nobr q ruby rb rp rt s samp"
    " small span strike strong sub sup time tt u var".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
ENDS_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}}
NOISE_TAGS = frozenset("nav header footer aside form menu dialog button select head figcaption".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies"
    " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription nav navbar navigation"
    " menu breadcrumb breadcrumbs header masthead topbar footer sidebar aside related recommended share sharing"
    " social comment comments respond disqus reply replies login signup search form pagination pager widget widgets"
    " toolbar skip copyright legal disclaimer".split()
)
IN_HEAD = frozenset("head base link meta".split())
MAIN_WORDS = frozenset("article content main post entry story".split())
#: Parts of a host whose pages are aligned first.
PARTS = 64


@dataclass
class Block:
    """A text with its place; ``path``: signatures of the elements around it."""

    path: tuple[str, ...]
    text: str
    noise: bool
    region: int
    link: bool


@dataclass
class Open:
    tag: str
    signature: str
    noise: bool
    region: int
    inline: bool


def _tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name, rest)``: kind is text, open or close. Raw elements are left out whole."""
    at = 0
    while True:
        found = TOKEN.search(page, at)
        if not found:
            if page[at:]:
                yield "text", "", page[at:]
            return
        if found.start() > at:
            yield "text", "", page[at : found.start()]
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        rest = found[3] if found[2] else found[6]
        if found[1] or found[4]:
            yield "close", name, ""
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            if end:
                at = end.end()
            elif name in ("script", "style", "title", "textarea"):
                return
        else:
            yield "open", name, rest or ""


def _opened(tag: str, attributes: str, around: list[Open]) -> Open:
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
    own_id = values.get("id", "").strip().lower()
    names = f"{values.get('class', '')} {own_id}".lower()
    parts = set(re.split(r"[^a-z]+", names)) if names.strip() else set()
    signature = tag + (f".{'.'.join(sorted(names.split()))}" if parts else "")
    region = max((o.region for o in around), default=0)
    inside = region > 0
    role = values.get("role", "").lower()
    noise = any(o.noise for o in around)
    if tag in ("html", "body"):
        pass
    elif tag in ("article", "main") or role in ("article", "main"):
        noise = noise or bool(parts & {"comment", "comments", "reply", "replies"})
        region = max(region, 3 if tag == "article" or role == "article" else 2)
    else:
        hidden = re.search(r"(?i)(^|\s)hidden(\s|=|$)", attributes) or "display:none" in values.get("style", "").replace(" ", "")
        # The heading of an article may stand in a header of its own.
        words = NOISE_WORDS - {"header"} if inside else NOISE_WORDS
        tags = NOISE_TAGS - {"header", "figcaption"} if inside else NOISE_TAGS - {"figcaption"}
        # In an article, ids are made from headings: only a whole one means something.
        if any(o.region >= 2 for o in around):
            parts = set(re.split(r"[^a-z]+", values.get("class", "").lower())) | {own_id}
        noise = noise or tag in tags or role in NOISE_ROLES or bool(parts & words) or bool(hidden)
        if not noise and parts & MAIN_WORDS:
            region = max(region, 1)
    return Open(tag, signature, noise, region, tag in INLINE)


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order, with character references decoded and blanks as one."""
    stack: list[Open] = []
    found: list[Block] = []
    pieces: list[str] = []
    linked = [0, 0]
    links = 0

    def flush() -> None:
        if not pieces:
            return
        text = " ".join(html.unescape("".join(pieces)).split())
        pieces.clear()
        if text:
            path = tuple(o.signature for o in stack if not o.inline)
            top = stack[-1] if stack else None
            found.append(Block(path, text, bool(top and top.noise), top.region if top else 0, linked[0] > linked[1] / 2))
        linked[:] = [0, 0]

    def close_to(place: int) -> None:
        if not all(o.inline for o in stack[place:]):
            flush()
        del stack[place:]

    def innermost(tags: set[str] | frozenset[str], until: set[str] | frozenset[str] = frozenset()) -> int:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in until:
                break
        return -1

    for kind, name, rest in _tokens(page):
        # Whatever can't stand in a head ends it, also without an end tag.
        if stack and (rest.strip() if kind == "text" else kind == "open" and name not in IN_HEAD):
            if (i := innermost({"head"})) >= 0:
                close_to(i)
        if kind == "text":
            if stack and stack[-1].noise and stack[-1].inline:
                continue
            pieces.append(rest)
            size = len(rest.strip())
            linked[1] += size
            linked[0] += size if links else 0
        elif kind == "open":
            if name == "br":
                pieces.append(" ")
            elif name in VOID:
                if name == "hr":
                    flush()
            elif name in INLINE:
                links += name == "a"
                if rest.strip():
                    stack.append(_opened(name, rest, stack))
            else:
                if name in CLOSES_P and (i := innermost({"p"}, {"td", "th", "li", "article", "section", "div", "body"})) >= 0:
                    close_to(i)
                if name in ENDS_BY and (i := innermost(ENDS_BY[name], HOLDS.get(name, frozenset()))) >= 0:
                    while (j := innermost(ENDS_BY[name], HOLDS.get(name, frozenset()))) >= 0:
                        i = j
                        close_to(i)
                flush()
                stack.append(_opened(name, rest, stack))
        elif name in INLINE:
            links = max(0, links - (name == "a"))
            for i in range(len(stack) - 1, -1, -1):
                if not stack[i].inline:
                    break
                if stack[i].tag == name:
                    close_to(i)
                    break
        elif (i := innermost({name})) >= 0:
            flush()
            close_to(i)
            links = 0
        elif name == "p":
            flush()
    flush()
    return found


# Wrappers. An element is [signature, how often, children]; a text is ["#", how often, hash or None for a slot, pages].


def _merge(a: list, b: list) -> list:
    """The wrapper of two elements with one signature."""
    times = a[1] if a[1] == b[1] else "*" if {a[1], b[1]} & {"*", "?"} and {a[1], b[1]} & {"*", "+"} else "?" if "?" in (a[1], b[1]) else "+"
    if a[0] == "#":
        return ["#", times, a[2] if a[2] == b[2] else None, a[3] + b[3]]
    return [a[0], times, _align(a[2], b[2])]


def _optional(x: list) -> list:
    return [x[0], {"1": "?", "+": "*"}.get(x[1], x[1]), *x[2:]]


def _repeat(x: list) -> list:
    return [x[0], {"1": "+", "?": "*"}.get(x[1], x[1]), *x[2:]]


def _same_page(a: list, b: list) -> list:
    """As :func:`_merge`, for two parts of one page: the pages are not added up."""
    merged = _merge(a, b)
    return _recount(merged, a) if a[0] != "#" else [*merged[:3], max(a[3], b[3])]


def _recount(merged: list, like: list) -> list:
    if merged[0] == "#":
        return [*merged[:3], 1 if like else merged[3]]
    return [merged[0], merged[1], [_recount(c, like) for c in merged[2]]]


def _folded(children: list[list]) -> list[list]:
    """Neighbours that repeat, alone or in groups of up to four, become repeated groups."""
    out: list[list] = []
    for child in children:
        if out and out[-1][0] == child[0]:
            out[-1] = _repeat(_same_page(out[-1], child))
        else:
            out.append(child)
    for width in (2, 3, 4):
        i = 0
        while i + 2 * width <= len(out):
            one, two = out[i : i + width], out[i + width : i + 2 * width]
            if [x[0] for x in one] == [x[0] for x in two]:
                out[i : i + 2 * width] = [_repeat(_same_page(x, y)) for x, y in zip(one, two, strict=True)]
            else:
                i += 1
    return out


def _align(a: list[list], b: list[list]) -> list[list]:
    """Children of both in order: those with equal signatures meet, the others become optional."""
    if [x[0] for x in a] == [x[0] for x in b]:
        return [_merge(x, y) for x, y in zip(a, b, strict=True)]
    n, m = len(a), len(b)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and a[i][0] == b[j][0]:
            out.append(_merge(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == m or i < n and best[i + 1][j] >= best[i][j + 1]:
            out.append(_optional(a[i]))
            i += 1
        else:
            out.append(_optional(b[j]))
            j += 1
    return out


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode(errors="replace")) - (1 << 63)


def page_wrapper(found: list[Block]) -> list:
    """The wrapper of one page."""

    def level(rows: list[tuple[tuple[str, ...], str]]) -> list[list]:
        children, i = [], 0
        while i < len(rows):
            path, text = rows[i]
            if not path:
                children.append(["#", "1", text_hash(text), 1])
                i += 1
                continue
            j = i
            while j < len(rows) and rows[j][0] and rows[j][0][0] == path[0] and (j == i or len(path) > 1):
                j += 1
            children.append([path[0], "1", level([(p[1:], t) for p, t in rows[i:j]])])
            i = j
        return _folded(children)

    return ["", "1", level([(b.path, b.text) for b in found])]


def constants(wrapper: list, least: int, path: tuple[str, ...] = ()) -> list[int]:
    """Hashes of place and text of all texts that were equal in ``least`` pages or more."""
    if wrapper[0] == "#":
        # The place counts, so that an article may quote its frame.
        if wrapper[2] is None or wrapper[3] < least or wrapper[1] in "+*":
            return []
        return [text_hash("\n".join([*path, str(wrapper[2])]))]
    inner = (*path, wrapper[0]) if wrapper[0] else path
    return [h for child in wrapper[2] for h in constants(child, least, inner)]


def expression(wrapper: list) -> str:
    """The wrapper as a regular expression over tags, for people."""
    if wrapper[0] == "#":
        inner = "#slot" if wrapper[2] is None else "#text"
    else:
        inner = f"<{wrapper[0]}>{''.join(expression(c) for c in wrapper[2])}</>" if wrapper[0] else "".join(
            expression(c) for c in wrapper[2]
        )
    return inner if wrapper[1] == "1" else f"({inner}){wrapper[1]}"


def main_text(page: str | None, frame: frozenset[int] = frozenset()) -> str:
    """The article of a page; ``frame``: :func:`constants` of its host."""
    found = blocks(page) if page else []
    clean = [b for b in found if not b.noise]
    best = max((b.region for b in clean), default=0)
    main = [b for b in clean if b.region == best and (best or not b.link)]
    # A frame text may stand in the main part, in an article too. If all is frame, the main part is what pages repeat.
    kept = [b for b in main if text_hash("\n".join([*b.path, str(text_hash(b.text))])) not in frame]
    if best and not kept:
        kept = main
    return "\n\n".join(b.text for b in kept)


def host(url: str = "url") -> Column:
    """Host of an address in lower case; none: empty."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def wrappers(pages: DataFrame, least: int = 3) -> DataFrame:
    """``host, pages, expression, frame`` of every host of ``pages(url, html)``.

    ``frame`` holds the texts that were the same in all pages that have their place, ``least``
    different pages at least; ``pages`` counts different pages, copies once. Pages without a host have none.
    """
    named = pages.select(host().alias("host"), F.col("html").cast("string").alias("html")).where("host <> ''")
    schema = "host string, part int, pages long, wrapper string"

    def rows(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in found], pa.string()),
                pa.array([r[1] for r in found], pa.int32()),
                pa.array([r[2] for r in found], pa.int64()),
                pa.array([json.dumps(r[3]) for r in found], pa.string()),
            ],
            names=["host", "part", "pages", "wrapper"],
        )

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            out = []
            for key, page in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
                found = blocks(page.as_py() or "")
                look = text_hash(json.dumps([(b.path, b.text) for b in found]))
                # Copies that other tasks hold, or that come after this is cleared, meet below.
                if (key, look) in seen:
                    continue
                if len(seen) >= 200_000:
                    seen.clear()
                seen.add((key, look))
                out.append((key, look % PARTS, look, json.dumps(page_wrapper(found))))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            types = [pa.string(), pa.int32(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["host", "part", "look", "wrapper"]
            )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row per host and part, in the order of the rows; the pages of a look come one after the other."""
        current, last, tree, count = None, None, None, 0
        for batch in batches:
            out = []
            for key, part, look, pages, wrapper in zip(
                *(batch.column(c).to_pylist() for c in ("host", "part", "look", "pages", "wrapper")), strict=True
            ):
                if (key, part) != current:
                    if current:
                        out.append((*current, count, tree))
                    current, tree, count = (key, part), json.loads(wrapper), pages
                elif look != last:
                    tree, count = _merge(tree, json.loads(wrapper)), count + pages
                last = look
            yield rows(out)
        if current:
            yield rows([(*current, count, tree)])

    looks = named.mapInArrow(infer, "host string, part int, look long, wrapper string").withColumn("pages", F.lit(1).cast("long"))
    # Two steps, so that no task meets all pages of a large host. What meets in which order depends on the
    # pages alone and not on how they are dealt to tasks.
    parts = looks.repartition("host", "part").sortWithinPartitions("host", "part", "look").mapInArrow(merged, schema)
    parts = parts.select("host", F.lit(0).alias("part"), F.col("part").cast("long").alias("look"), "pages", "wrapper")
    whole = parts.repartition("host").sortWithinPartitions("host", "look").mapInArrow(merged, schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees = [json.loads(w) for w in batch.column("wrapper").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("host"),
                    batch.column("pages"),
                    pa.array([expression(t) for t in trees], pa.string()),
                    pa.array([sorted(set(constants(t, least))) for t in trees], pa.list_(pa.int64())),
                ],
                names=["host", "pages", "expression", "frame"],
            )

    return whole.mapInArrow(finish, "host string, pages long, expression string, frame array<long>")


def extract(pages: DataFrame, found: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``, with the wrappers of its host.

    Null html is empty; pages without text give an empty one; repeated rows each give a row; other
    columns are ignored.
    """
    framed = saved(found.where(F.size("frame") > 0).select(F.col("host").alias("_host"), "frame"), "frames")
    held = framed.agg(F.sum(F.size("frame") + 4)).first()[0] or 0
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html"
    )
    joined = narrow.join(small_side(framed, held, 2_000_000), host() == F.col("_host"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(page.as_py(), frozenset(frame.as_py() or ()))
                for page, frame in zip(batch.column("html"), batch.column("frame"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    texts = joined.select("page_id", "url", "html", "frame").mapInArrow(run, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, wrappers(pages))


QUERIES = {"op2_html_extraction": op2_html_extraction}
