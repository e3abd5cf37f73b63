"""Main text of web pages through wrappers inferred by host (operator 12).

A page becomes a balanced stream of block tokens: elements, and text between
them.  All streams of a host are aligned into one union-free regular
expression, its wrapper, which has elements, text slots, optional parts and
repeated groups, but no alternatives:

- tokens of the same signature (tag and telling class or id words) match, and
  their contents are aligned in turn;
- a mismatch beside an equal token, or a token that comes back later, makes a
  repeated group: ``p ul p h2 p`` becomes ``(p? ul? h2?)+``;
- any other mismatch makes an optional part.

The wrapper shows where a host keeps its article.  A page is matched against
it, and the text of the nodes that meet that part is taken, without what menus,
adverts, comments and the like hold inside it.  If no page of a host marks an
article, its text slots decide: those that say the same on every page are the
host's own words and go, as do blocks that are mostly links.

Scale.  A page gives one short skeleton; equal ones of a host are counted
before anything is shuffled.  Skeletons are aligned in the order of their
text, first in buckets and then bucket by bucket, so a wrapper does not depend
on how the pages are dealt out and a hot host is not one task.  Signatures
come from fixed lists, so a wrapper grows with the kinds of pages of a host
and not with their number.  Pages meet their wrapper on the host and a salt; a
host with more than 1 / HOT of all pages is spread over SALTS salts.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .common import SLICE_ROWS, ascii_lower, worker_cache

# fixed values: HTML's elements by what they mean for text
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "html head body article section main nav aside header footer address blockquote center details dialog dd div dl dt fieldset figcaption figure form "
    "h1 h2 h3 h4 h5 h6 hgroup hr li menu ol p pre search summary table caption colgroup thead tbody tfoot tr td th ul".split()
)
HEAD = frozenset("base link meta noscript script style template title".split())
#: What a start tag ends, if it is open in the same container.
ENDS = {t: frozenset(("p",)) for t in BLOCK - {"html", "head", "body"}}
ENDS |= {"li": frozenset("li p".split()), "dt": frozenset("dt dd p".split()), "dd": frozenset("dt dd p".split()), "tr": frozenset("tr td th p".split())}
ENDS |= {t: frozenset("td th p".split()) for t in ("td", "th")} | {t: frozenset("thead tbody tfoot tr td th p".split()) for t in ("thead", "tbody", "tfoot")}
ENDS["body"] = frozenset(("head",))
#: Containers that an implied end does not reach beyond.
SCOPE = frozenset("html body article section main nav aside header footer blockquote details dialog div dl fieldset figure form ol ul menu table td th".split())
#: Tokens whose repetition is content; others come back only by mismatch.
FLOW = frozenset("# p li dt dd tr td th thead tbody tfoot h1 h2 h3 h4 h5 h6 hr pre blockquote ul ol dl table figure figcaption caption".split())
#: Never part of an article.
DROPPED = frozenset("head nav aside footer form script style template noscript title textarea iframe object embed svg canvas audio video map select button dialog menu search xmp noembed noframes".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Class and id words of menus, notices, adverts and comments.
DROPPED_WORDS = frozenset(
    "nav navbar navigation menu sidebar footer ad ads advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice popup modal overlay "
    "newsletter subscribe subscription signup comment comments respond replies disqus share sharing social breadcrumb breadcrumbs related recommended pagination pager login search toolbar widget".split()
)
#: Of headers outside an article, and of elements that hold one.
HEADER_WORDS = frozenset("header masthead banner topbar".split())
ARTICLE_WORDS = frozenset("article post story entry articlebody".split())
MAIN_WORDS = frozenset("content main maincontent".split())

#: Elements nested deeper are taken as neighbours.
DEPTH = 100
#: Containers that come back more often among the contents of one element are a repeated group like content.
RUN = 8
#: Skeletons of a host are aligned in so many buckets first.
BUCKETS = 32
#: A host with more than 1 / HOT of all pages is spread over SALTS tasks.
HOT, SALTS = 500, 64
#: Skeletons that a worker remembers; then it starts anew.
KEPT = 20_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>)|[^>]*)>|<[!?/][^>]*>|<[a-zA-Z!?/][^>]*\Z|[^<]+|<", re.S
)
ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Node:
    """An element or, with the tag "#", a text.  ``rank`` tells how clearly an element is the article (0: not at all)."""

    __slots__ = ("tag", "sig", "kids", "text", "link", "dropped", "rank")

    def __init__(self, tag: str, sig: str, text: str = "", link: bool = False, dropped: bool = False, rank: int = 0):
        self.tag, self.sig, self.text, self.link, self.dropped, self.rank, self.kids = tag, sig, text, link, dropped, rank, []


def _element(tag: str, attributes: str) -> Node:
    known = {}
    for name, value in ATTRIBUTE.findall(attributes) if "=" in attributes else ():
        known.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    words = {w.lower() for w in WORD.findall(f"{known.get('class', '')} {known.get('id', '')}")}
    role = known.get("role", "").strip().lower()
    if tag in ("html", "body"):
        return Node(tag, tag)
    if tag == "article" or role == "article" or known.get("itemprop", "").lower() == "articlebody":
        rank = 3
    elif tag == "main" or role == "main":
        rank = 2
    else:
        rank = 1 if tag in ("div", "section", "td") and words & (ARTICLE_WORDS | MAIN_WORDS) else 0
    dropped = tag in DROPPED or role in DROPPED_ROLES or bool(words & DROPPED_WORDS)
    if dropped:
        return Node(tag, f"{tag if tag in BLOCK or tag in DROPPED else 'span'}-", dropped=True)
    head = tag == "header" or bool(words & HEADER_WORDS) and not words & ARTICLE_WORDS
    return Node(tag, tag + (f"*{rank}" if rank else "") + ("^" if head else ""), rank=rank)


def is_head(node: Node) -> bool:
    return node.sig[-1:] == "^"


def parse(source: str) -> Node:
    """The block elements of a page with the texts between them; inline elements are left out, unless they hold what is dropped."""
    root = Node("#root", "#root")
    stack, tags, links, at = [root], ["#root"], 0, 0
    too_deep: dict[str, int] = {}
    match = TOKEN.match
    while m := match(source, at):
        at = m.end()
        token = m[0]
        tag = m[2]
        if tag is None:
            if token[0] != "<" or token == "<":
                text = html.unescape(token) if "&" in token else token
                top = stack[-1]
                if top.kids and top.kids[-1].tag == "#" and top.kids[-1].link == (links > 0):
                    top.kids[-1].text += text
                else:
                    top.kids.append(Node("#", "#", text, links > 0))
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "a" or tag in BLOCK:
                links = 0
            if too_deep.get(tag):
                too_deep[tag] -= 1
            elif tag in tags:
                where = len(tags) - 1 - tags[::-1].index(tag)
                if tag in SCOPE or not any(t in SCOPE for t in tags[where + 1 :]):
                    del stack[where:], tags[where:]
            continue
        if tag == "br":
            stack[-1].kids.append(Node("#", "#", " ", links > 0))
            continue
        node = _element(tag, m[3])
        node.dropped = node.dropped or stack[-1].dropped and tags[-1] != "head"
        if tag in RAW:  # up to its end tag, whatever is inside
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(source, at)
            at = end.end() if end else len(source)
            node.dropped = True
            stack[-1].kids.append(node)
            continue
        if tags[-1] == "head" and tag not in HEAD:
            del stack[-1], tags[-1]
        ended = ENDS.get(tag)
        if ended:
            floor = len(tags)
            while floor > 1 and (tags[floor - 1] not in SCOPE or tags[floor - 1] in ended):
                floor -= 1
            first = next((i for i in range(floor, len(tags)) if tags[i] in ended), None)
            if first is not None:
                del stack[first:], tags[first:]
        if tag in BLOCK or node.dropped:
            stack[-1].kids.append(node)
            if tag in VOID:
                continue
            if len(stack) < DEPTH or node.dropped:
                stack.append(node)
                tags.append(tag)
            else:
                too_deep[tag] = too_deep.get(tag, 0) + 1
        elif tag == "a":
            links = 1
    return root


# wrappers


class Part:
    """A part of a wrapper: an element with contents, a text slot "#", or a group "()" whose members are optional.  ``nodes``: what of a page is there."""

    __slots__ = ("sig", "least", "many", "kids", "nodes")

    def __init__(self, sig: str, least: int = 1, many: int = 0, kids: list | None = None, nodes: list | None = None):
        self.sig, self.least, self.many, self.kids, self.nodes = sig, least, many, kids or [], nodes or []

    def signs(self) -> list[str]:
        return [k.sig for k in self.kids] if self.sig == "()" else [self.sig]

    def dump(self) -> list:
        return [self.sig, self.least, self.many, [k.dump() for k in self.kids]]


def load(raw: list) -> Part:
    return Part(raw[0], raw[1], raw[2], [load(k) for k in raw[3]])


def union(a: Part, b: Part) -> Part:
    """Two parts that match, as one; a group takes the other in."""
    if a.sig == b.sig != "()":
        return Part(a.sig, min(a.least, b.least), a.many | b.many, align(a.kids, b.kids), a.nodes + b.nodes)
    members: dict[str, Part] = {}
    for x in (a, b):
        for k in x.kids if x.sig == "()" else [x]:
            members[k.sig] = union(members[k.sig], k) if k.sig in members else k
    for k in members.values():
        k.least = 0
    return Part("()", min(a.least, b.least), 1, list(members.values()))


def fold(parts: list[Part]) -> list[Part]:
    """Content tokens that come back make a repeated part with all that lies between; so do others that come back often."""
    last: dict[str, int] = {}
    count: dict[str, int] = {}
    for i, p in enumerate(parts):
        for s in p.signs():
            count[s] = count.get(s, 0) + 1
            last[s] = i
    last = {s: i for s, i in last.items() if s in FLOW or count[s] > RUN}
    out, i = [], 0
    while i < len(parts):
        p, end, j = parts[i], i, i
        while j <= end:  # the region grows with the last place of each token in it
            for s in parts[j].signs():
                end = max(end, last.get(s, j))
            j += 1
        for q in parts[i + 1 : end + 1]:
            p = union(p, q)
            p.many = 1
        out.append(p)
        i = end + 1
    return out


def pairs(a: list[Part], b: list[Part]) -> list[tuple[int, int]]:
    """Which parts match, in order: as many as possible, the earlier ones on a tie."""
    start = 0
    while start < min(len(a), len(b)) and a[start].sig == b[start].sig:
        start += 1
    front = [(i, i) for i in range(start)]
    a, b = a[start:], b[start:]
    if not a or not b:
        return front
    signs = [set(p.signs()) for p in a], [set(p.signs()) for p in b]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            hit = 2 + (a[i].sig == b[j].sig) + best[i + 1][j + 1] if signs[0][i] & signs[1][j] else 0
            best[i][j] = max(hit, best[i + 1][j], best[i][j + 1])
    i = j = 0
    while i < len(a) and j < len(b):
        if signs[0][i] & signs[1][j] and best[i][j] == 2 + (a[i].sig == b[j].sig) + best[i + 1][j + 1]:
            front.append((start + i, start + j))
            i, j = i + 1, j + 1
        elif best[i][j] == best[i + 1][j]:
            i += 1
        else:
            j += 1
    return front


def align(a: list[Part], b: list[Part]) -> list[Part]:
    """One list of parts that fits all that either fits."""
    out: list[Part] = []

    def lonely(p: Part) -> None:
        """A mismatch: a repetition of its neighbour, or optional."""
        if out and out[-1].sig == p.sig != "()":
            out[-1] = union(out[-1], p)
            out[-1].many = 1
        else:
            p.least = 0
            out.append(p)

    i = j = 0
    for x, y in [*pairs(a, b), (len(a), len(b))]:
        for p in (*a[i:x], *b[j:y]):
            lonely(p)
        if x < len(a):
            one = union(a[x], b[y])
            if out and out[-1].sig == one.sig and not out[-1].least and one.sig != "()":  # the mismatch before was a repetition of this one
                one = union(out.pop(), one)
                one.least, one.many = 1, 1
            out.append(one)
        i, j = x + 1, y + 1
    return fold(out)


def parts_of(node: Node) -> list[Part]:
    """The contents of an element as wrapper parts."""
    out = []
    for k in node.kids:
        if k.tag == "#":
            if k.text.strip():
                out.append(Part("#", nodes=[k]))
        else:
            out.append(Part(k.sig, kids=[] if k.dropped else parts_of(k), nodes=[k]))
    return fold(out)


def skeleton(source: str) -> str:
    return json.dumps([p.dump() for p in parts_of(parse(source))], separators=(",", ":"))


def merge(skeletons: Iterator[str]) -> str:
    """One wrapper for all skeletons or wrappers given."""
    wrapper = None
    for s in skeletons:
        new = [load(p) for p in json.loads(s)]
        wrapper = new if wrapper is None else align(wrapper, new)
    return json.dumps([p.dump() for p in wrapper or []], separators=(",", ":"))


def _rank(sig: str) -> int:
    return int(sig[sig.index("*") + 1]) if "*" in sig else 0


def regroup(wrapper: list[Part], page: list[Part]) -> list[Part]:
    """The parts of a page with neighbours that belong to one group of the wrapper as one part."""
    group = {s: i for i, w in enumerate(wrapper) if w.sig == "()" for s in w.signs()}
    out: list[Part] = []
    for p in page:
        mine = {group.get(s) for s in p.signs()}
        if out and len(mine) == 1 and None not in mine and mine == {group.get(s) for s in out[-1].signs()}:
            out[-1] = union(out[-1], p)
        else:
            out.append(p)
    return out


def matched(wrapper: list[Part], page: list[Part], address: str = "") -> Iterator[tuple[str, Part, Part]]:
    """(address, wrapper part, page part) of all that match, outer parts first."""
    page = regroup(wrapper, page)
    for i, j in pairs(wrapper, page):
        w, p = wrapper[i], page[j]
        known = {k.sig: k for k in (w.kids if w.sig == "()" else [w])}
        for k in p.kids if p.sig == "()" else [p]:
            if k.sig in known:
                here = f"{address}/{i}{k.sig}"
                yield here, known[k.sig], k
                yield from matched(known[k.sig].kids, k.kids, here)


def article_nodes(wrapper: list[Part], page: list[Part]) -> list[Node]:
    """The nodes of a page where its host keeps the article: those of the highest rank that the wrapper has, or of the highest that this page has."""
    found = [(_rank(p.sig), p.nodes) for _, _, p in matched(wrapper, page) if _rank(p.sig)]
    top = max((r for r, _ in found), default=0)
    return [n for r, nodes in found if r == top for n in nodes]


def blocks(node: Node, inside: bool, literal: frozenset = frozenset(), out: list | None = None) -> list[tuple[str, int, int]]:
    """(text, characters, characters in links) of each block, white space as one space.  ``inside``: of an article, where headers belong to the text.  ``literal``: texts nodes that are left out, by identity."""
    out, open_ = [] if out is None else out, []

    def end() -> None:
        text = " ".join("".join(n.text for n in open_).split())
        if text:
            out.append((text, sum(len(n.text.strip()) for n in open_), sum(len(n.text.strip()) for n in open_ if n.link)))
        open_.clear()

    for k in node.kids:
        if k.tag == "#":
            if id(k) not in literal:
                open_.append(k)
        elif k.dropped:
            if k.tag in BLOCK:
                end()
        else:
            end()
            if inside or not is_head(k):
                blocks(k, inside, literal, out)
    end()
    return out


def _outermost(nodes: list[Node]) -> list[Node]:
    """Those that no other one holds, in page order."""
    inner = set()
    for n in nodes:
        todo = list(n.kids)
        while todo:
            k = todo.pop()
            inner.add(id(k))
            todo += k.kids
    return [n for n in nodes if id(n) not in inner]


def in_order(root: Node, nodes: list[Node]) -> list[Node]:
    wanted, out, todo = {id(n) for n in nodes}, [], [root]
    while todo:
        n = todo.pop()
        if id(n) in wanted:
            out.append(n)
        todo += reversed(n.kids)
    return out


def extract(source: str, wrapper: list[Part], literal: frozenset = frozenset()) -> str:
    """The main text of a page of a host with this wrapper; ``literal``: addresses of the slots with the host's own words."""
    root = parse(source)
    page = parts_of(root)
    nodes = article_nodes(wrapper, page)
    if nodes:
        return "\n".join(t for n in in_order(root, _outermost(nodes)) for t, _, _ in blocks(n, True))
    own = frozenset(id(n) for a, w, p in matched(wrapper, page) if a in literal for n in p.nodes)
    return "\n".join(t for t, n, in_links in blocks(root, False, own) if 2 * in_links <= n)


def slots(source: str, wrapper: list[Part]) -> list[tuple[str, str]]:
    """(address, text) of every text slot of a page without an article."""
    page = parts_of(parse(source))
    if article_nodes(wrapper, page):
        return []
    return [(a, "\n".join(" ".join(n.text.split()) for n in p.nodes)) for a, _, p in matched(wrapper, page) if p.sig == "#"]


# Spark


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def _skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, skeleton, pages), one row for those of a slice that are equal."""
    schema = pa.schema([("host", pa.string()), ("skeleton", pa.string()), ("pages", pa.int64())])
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            part = b.slice(at, SLICE_ROWS)
            count: dict = {}
            for host, source in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                key = host, skeleton(source or "")
                count[key] = count.get(key, 0) + 1
            yield pa.RecordBatch.from_pylist([{"host": h, "skeleton": s, "pages": n} for (h, s), n in count.items()], schema)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the skeletons of sorted rows (host, bucket, skeleton, pages) with the same host and bucket."""
    schema = pa.schema([("host", pa.string()), ("bucket", pa.int32()), ("skeleton", pa.string()), ("pages", pa.int64())])
    last, wrapper, pages = None, None, 0
    out: list[dict] = []

    def done() -> None:
        if last is not None:
            out.append({"host": last[0], "bucket": last[1], "skeleton": json.dumps([p.dump() for p in wrapper], separators=(",", ":")), "pages": pages})

    for b in batches:
        for row in b.to_pylist():
            key = row["host"], row["bucket"]
            new = [load(p) for p in json.loads(row["skeleton"])]
            if key != last:
                done()
                last, wrapper, pages = key, new, 0
            else:
                wrapper = align(wrapper, new)
            pages += row["pages"]
        if len(out) >= SLICE_ROWS:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
    done()
    yield pa.RecordBatch.from_pylist(out, schema)


MERGED = "host string, bucket int, skeleton string, pages long"


def infer_wrappers(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """``(host, wrapper, pages)``: one union-free expression per host (as JSON: signature, least, many, contents), aligned from all its pages."""
    read = pages.select(host_of(F.col(url)).alias("host"), F.col(source).alias("html"))
    kinds = read.mapInArrow(_skeletons, "host string, skeleton string, pages long").groupBy("host", "skeleton").agg(F.sum("pages").alias("pages"))
    dealt = kinds.select("host", F.pmod(F.xxhash64("skeleton"), F.lit(BUCKETS)).cast("int").alias("bucket"), "skeleton", "pages")
    some = dealt.repartition("host", "bucket").sortWithinPartitions("host", "bucket", "skeleton").mapInArrow(_merged, MERGED)
    whole = some.withColumn("part", F.col("bucket")).withColumn("bucket", F.lit(0))
    whole = whole.repartition("host").sortWithinPartitions("host", "part").select("host", "bucket", "skeleton", "pages").mapInArrow(_merged, MERGED)
    return whole.select("host", F.col("skeleton").alias("wrapper"), "pages")


def _loaded(raw: str) -> list[Part]:
    kept = worker_cache("wrappers")
    if raw not in kept:
        if len(kept) > KEPT:
            kept.clear()
        kept[raw] = [load(p) for p in json.loads(raw)]
    return kept[raw]


def _slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    schema = pa.schema([("host", pa.string()), ("slot", pa.string()), ("said", pa.int64())])
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            rows = [
                {"host": r["host"], "slot": slot, "said": xxhash.xxh64_intdigest(text) - (1 << 63)}
                for r in b.slice(at, SLICE_ROWS).to_pylist()
                for slot, text in slots(r["html"] or "", _loaded(r["wrapper"]))
            ]
            yield pa.RecordBatch.from_pylist(rows, schema)


def _with_wrapper(read: DataFrame, wrappers: DataFrame, total: int) -> DataFrame:
    """``read`` with the columns of ``wrappers`` of its host; hot hosts (fewer than HOT, so they are broadcast) are salted."""
    hot = wrappers.where(F.col("pages") * HOT > total).select("host", F.lit(SALTS).alias("salts"))
    salted = read.join(F.broadcast(hot), "host", "left").withColumn("salt", F.pmod(F.xxhash64("id", "html"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    salts = F.when(F.col("pages") * HOT > total, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(wrappers.withColumn("salt", F.explode(salts)).drop("pages"), ["host", "salt"])


def main_text(pages: DataFrame, id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """``(id, url, host, text)``, one row per page, the text empty if there is none.

    A null url has the host "", null html counts as empty.  Repeated rows give
    equal rows and do not change a wrapper's form; an empty table gives no
    rows; other columns are not read, so their names may clash."""
    spark = pages.sparkSession
    wrappers = freeze(infer_wrappers(pages, url, source), "wrappers")
    total = wrappers.agg(F.sum("pages")).first()[0] or 0
    read = pages.select(F.col(id).cast("string").alias("id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(source).alias("html"))

    unmarked = wrappers.where(~F.col("wrapper").rlike(MARKED))
    if unmarked.limit(1).count():
        rows = _with_wrapper(read, unmarked, total).select("host", "html", "wrapper").mapInArrow(_slot_rows, "host string, slot string, said long")
        same = rows.groupBy("host", "slot").agg(F.min("said").alias("low"), F.max("said").alias("high"), F.count("*").alias("n")).where("low = high and n > 1")
        literal = same.groupBy("host").agg(F.sort_array(F.collect_list("slot")).alias("literal"))  # at most the slots of a wrapper
    else:
        literal = spark.createDataFrame([], "host string, literal array<string>")
    told = _with_wrapper(read, wrappers.join(literal, "host", "left"), total)
    schema = pa.schema([("id", pa.string()), ("url", pa.string()), ("host", pa.string()), ("text", pa.string())])

    def texts(batches):
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                part = b.slice(at, SLICE_ROWS)
                got = [
                    extract(s or "", _loaded(w), frozenset(own or ()))
                    for s, w, own in zip(part.column("html").to_pylist(), part.column("wrapper").to_pylist(), part.column("literal").to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), part.column("host"), pa.array(got, pa.string())], schema=schema)

    out = told.select("id", "url", "host", "html", "wrapper", "literal").mapInArrow(texts, "id string, url string, host string, text string")
    return out.select(F.col("id").cast(pages.schema[id].dataType).alias(id), F.col("url").alias(url), "host", "text")


#: Of the JSON of a wrapper that marks an article: an element of any rank.
MARKED = r"\*[123]"
