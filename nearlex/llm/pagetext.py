"""Main text of web pages by consensus of a host's pages.

A page is cut into blocks by its block-level tags.  Blocks below boilerplate
tags are dropped.  A word of a class, id or role only marks an element: its blocks
weigh less in the choice of the container, and they are dropped if the element is
small or full of links beside the page and does not hold its article.  Reader
comments are dropped whatever their size.  Each page scores the containers of the
remaining blocks and votes for the best one, named by its generalised path: tags
with classes, digits masked.  Spark adds, per host and path, the votes and the
pages that have it.  A path is winning if most pages that have it vote for it, and
a side path if most do not.  Every page is extracted again: below the first winning
path that holds nearly all of its own best container; else below its own choice,
if that is winning or rare on the host (another layout); else, its choice being a
side path, below the first winning path it has.

Edge cases: null or empty html gives the empty text, and so does a page with
boilerplate or comments only.  Equal votes are ordered by path.  A null or odd url belongs to the empty host.  Repeated pages
vote once per row.  Extra columns are dropped.
"""

from __future__ import annotations

import bisect
import html as entities
import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearlex.llm.base import bound_batches
from nearlex.session import broadcast_if_small, stage

# Element names of the HTML standard by their role here.
SILENT = frozenset("script style noscript template iframe svg math object canvas audio video title textarea".split())
BOILERPLATE = frozenset("nav header footer aside form button select dialog menu head".split()) | SILENT
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCKS = frozenset(
    "html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th"
    " caption blockquote pre figure figcaption address fieldset details summary hgroup center hr".split()
)
CONTAINERS = frozenset("html body article section main div td blockquote".split())
PARAGRAPH = frozenset({"p"})
#: Elements a start tag ends without an end tag.
ENDS = {
    "li": frozenset({"p", "li"}), "dt": frozenset({"p", "dt", "dd"}), "dd": frozenset({"p", "dt", "dd"}),
    "td": frozenset({"p", "td", "th"}), "th": frozenset({"p", "td", "th"}), "tr": frozenset({"p", "td", "th", "tr"}),
}
#: Words of a class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies"
    " consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup menu nav navbar"
    " navigation breadcrumb breadcrumbs sidebar widget widgets related recommended share sharing social comment"
    " comments disqus respond replies footer header masthead toolbar pagination pager login contentinfo"
    " complementary search adbox adslot adbanner adsense topnav subnav sidenav sitenav topbar cookiebar commentlist".split()
)
#: A marked element is dropped below this share of the page's text outside links: named by
#: marks alone, or by marks among other words ("related-work", "with-sidebar").
MARKED_SHARE = (0.5, 0.05)
#: A class, id or role of these words alone, one of the first among them, holds reader comments.
COMMENT = frozenset("comment comments commentlist disqus respond replies reply".split())
COMMENT_PARTS = COMMENT | frozenset("list area section thread wrapper wrap container box block item body content text tree".split())
#: Start tags that end a boilerplate element whose end tag is missing.
NEXT = frozenset("main article section div header footer aside nav h1 h2 p".split())
#: Weight of a marked block in the score of a container.
MARKED_WEIGHT = 0.1
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words that speak for a container.
PRAISE = frozenset("article content main post entry story body text".split())
#: Share of a host's pages from which a path counts as winning or side path; so no host has many.
PATH_SHARE = 0.01
#: Share of a container's text that a path inside or beside it must hold to stand for it.
NEARLY_ALL = 0.9
#: Characters outside links from which a block that ends like a sentence is prose.
PROSE_CHARS = 60
SENTENCE_ENDS = ".!?…。！？\"”’»)"
#: Between the steps of a path: no class name holds a blank, many hold slashes.
PATH_MARK = " "

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>", re.S)
_NAMES = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
_SAME = {name: re.compile(f"<(/?){name}(?=[\\s/>])", re.I) for name in BOILERPLATE - SILENT}
_ENDS = {name: re.compile(f"</{name}[\\s/>]", re.I) for name in SILENT}


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    path: tuple[str, ...]  # generalised names of the containers around it
    marks: tuple[int, ...] = ()  # the marked elements around it

    @property
    def prose(self) -> bool:
        """Whether the block reads like a paragraph of a story."""
        return not self.marks and len(self.text) - 2 * self.linked >= PROSE_CHARS and self.text[-1] in SENTENCE_ENDS

    @property
    def value(self) -> float:
        """Characters outside links, as a score."""
        return max(len(self.text) - 2 * self.linked, 0) * (MARKED_WEIGHT if self.marks else 1.0)


def _marked(tag: str, names: list[tuple[str, ...]]) -> int:
    """0 without a mark, 1 if a name is of marks alone, 2 if marks are among other words, 3 for reader comments."""
    found = 0
    for kind, *values in names:
        if tag in HEADINGS or (tag == "p" and kind.lower() == "id"):
            continue
        for name in "".join(values).lower().split():
            words = _WORDS.findall(name)
            hits = sum(w in MARKS for w in words)
            if COMMENT.intersection(words) and COMMENT_PARTS.issuperset(words):
                return 3
            if hits == len(words) and hits:
                found = 1
            elif hits:
                found = found or 2
    return found


def _without_marked(parts: list[Block], kinds: list[int], holders: frozenset[int]) -> list[Block]:
    """The blocks outside marked elements that are small or full of links; holders of the article lose their mark."""
    page, inside = 0, [0] * len(kinds)
    for part in parts:
        value = max(len(part.text) - 2 * part.linked, 0)
        page += value
        for m in part.marks:
            inside[m] += value
    drop = {
        m for m, kind in enumerate(kinds)
        if m not in holders and (kind == 3 or not inside[m] or inside[m] < MARKED_SHARE[kind - 1] * page)
    }
    out = [p for p in parts if drop.isdisjoint(p.marks)]
    for part in out:
        part.marks = tuple(m for m in part.marks if m not in holders)
    return out


class _Pairs:
    """Which boilerplate elements of a page lack their end tag; one pass over the page for each name."""

    def __init__(self, page: str) -> None:
        self.page, self.places = page, {}

    def unclosed(self, tag: str, at: int) -> bool:
        """Whether the element opened before ``at`` lacks it: another one opens first and ends are too few."""
        if tag not in self.places:
            found = [(m.start(), bool(m.group(1))) for m in _SAME[tag].finditer(self.page)]
            self.places[tag] = [p for p, end in found if not end], [p for p, end in found if end]
        starts, ends = self.places[tag]
        s, e = bisect.bisect_left(starts, at), bisect.bisect_left(ends, at)
        if e < len(ends) and (s == len(starts) or ends[e] < starts[s]):
            return False
        return len(ends) - e <= len(starts) - s


def blocks(page: str) -> list[Block]:
    """Text blocks outside boilerplate, in page order."""
    out: list[Block] = []
    open_tags: list[tuple[str, bool, str | None, int | None]] = []  # tag, boilerplate, container name, mark
    kinds: list[int] = []
    holders: frozenset[int] | None = None  # marks around the first article
    pieces: list[tuple[str, bool]] = []
    hidden = links = at = 0
    pairs = _Pairs(page)
    cut_short: list[int] = []  # depths of boilerplate without an end tag

    def flush() -> None:
        if not pieces:
            return
        text = " ".join("".join(p for p, _ in pieces).split())
        if text:
            linked = sum(len(p.strip()) for p, inside in pieces if inside)
            out.append(Block(text, linked, tuple(t[2] for t in open_tags if t[2]), tuple(t[3] for t in open_tags if t[3] is not None)))
        pieces.clear()

    def close(depth: int) -> None:
        nonlocal hidden, links
        flush()
        for tag, bad, _, _ in open_tags[depth:]:
            hidden -= bad
            links -= tag == "a"
        del open_tags[depth:]
        while cut_short and cut_short[-1] >= depth:
            cut_short.pop()

    while at < len(page):
        found = _TOKEN.search(page, at)
        end = found.start() if found else len(page)
        if end > at and not hidden:
            pieces.append((entities.unescape(page[at:end]), links > 0))
        if not found:
            break
        at = found.end()
        slash, tag, rest = found.group(1), (found.group(2) or "").lower(), found.group(3) or ""
        if not tag:
            continue
        if slash:
            for depth in range(len(open_tags) - 1, -1, -1):
                if open_tags[depth][0] == tag:
                    if tag == "a":
                        links -= 1
                        del open_tags[depth]
                    else:
                        close(depth)
                    break
            continue
        names = _NAMES.findall(rest)
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br" and not hidden:
                pieces.append((" ", False))
            continue
        if tag in SILENT:
            stop = _ENDS[tag].search(page, at)
            at = stop.start() if stop else len(page)
            if stop:
                at = page.find(">", at) + 1 or len(page)
            continue
        if tag == "a":
            open_tags.append((tag, False, None, None))
            links += 1
            continue
        if tag in NEXT and cut_short and all(t[0] == "a" for t in open_tags[cut_short[-1] + 1 :]):
            close(cut_short[-1])
        headline = tag == "header" and any(t[0] in ("article", "main") for t in open_tags)
        bad = tag in BOILERPLATE and not headline
        kind = _marked(tag, names)
        if tag in ("main", "article") and not kind and not hidden and holders is None:
            holders = frozenset(t[3] for t in open_tags if t[3] is not None)
        mark = None
        exempt = ("html", "body", "main") if kind == 3 else ("html", "body", "main", "article")
        if kind and not bad and not headline and tag not in exempt:
            mark = len(kinds)
            kinds.append(kind)
        if tag not in BLOCKS and not bad and not headline and mark is None:
            continue  # inline markup
        flush()
        ends = ENDS.get(tag, PARAGRAPH)
        for depth in range(len(open_tags) - 1, -1, -1):  # end tags that may be left out
            if open_tags[depth][0] in ends:
                close(depth)
            elif open_tags[depth][0] != "a":
                break
        name = None
        if tag in CONTAINERS:
            classes = sorted({_DIGITS.sub("0", c) for n in names if n[0].lower() == "class" for c in "".join(n[1:]).split()})
            name = ".".join([tag, *classes])
        hidden += bad
        if bad and pairs.unclosed(tag, at):
            cut_short.append(len(open_tags))
        open_tags.append((tag, bad, name, mark))
    flush()
    return _without_marked(out, kinds, holders or frozenset())


def weights(parts: list[Block]) -> dict[tuple[str, ...], tuple[float, float]]:
    """Characters outside links of every container, and those of them in prose."""
    out: dict[tuple[str, ...], tuple[float, float]] = {}
    for part in parts:
        value = part.value
        prose = value if part.prose else 0.0
        for depth in range(1, len(part.path) + 1):
            path = part.path[:depth]
            held = out.get(path, (0.0, 0.0))
            out[path] = held[0] + value, held[1] + prose
    return out


def best_container(
    parts: list[Block], weight: dict[tuple[str, ...], tuple[float, float]] | None = None
) -> tuple[str, ...] | None:
    """The container whose blocks read most like an article.

    A container scores the characters outside links of all its blocks.  Going
    down must keep nearly all of them; if the name speaks for the inner one, half
    of them will do, but still nearly all prose.  An article is never cut further.
    """
    best, value, prose, praised = None, 0.0, 0.0, False
    for path, (total, story) in sorted((weight or weights(parts)).items(), key=lambda x: (len(x[0]), x[0])):
        praise = path[-1] != "body" and not PRAISE.isdisjoint(_WORDS.findall(path[-1].removeprefix("body.")))
        if best is None:
            fits = total > 0
        elif path[: len(best)] != best or best[-1].startswith("article"):
            fits = False
        elif praise:
            fits = total >= 0.5 * value and story >= NEARLY_ALL * prose
        else:
            fits = not praised and total >= NEARLY_ALL * value
        if fits:
            best, value, prose, praised = path, total, story, praise
    return best


def chosen(parts: list[Block], winning: list[str], side: list[str]) -> tuple[str, ...] | None:
    """The container of a page, given its host's winning paths (best first) and side paths."""
    weight = weights(parts)
    own = best_container(parts, weight)
    if own is None:
        return None
    name = PATH_MARK.join(own)
    met = [p for p in (tuple(w.split(PATH_MARK)) for w in winning) if p in weight]
    for path in met:
        if weight[path][0] >= NEARLY_ALL * weight[own][0]:
            return path
    return met[0] if met and name in side and name not in winning else own


def rendered(parts: list[Block], path: tuple[str, ...] | None) -> str:
    chosen = parts if path is None else [p for p in parts if p.path[: len(path)] == path]
    return "\n\n".join(p.text for p in chosen)


def host_of(url: Column) -> Column:
    """Lower-case host: after the first ``://`` up to a slash, question mark or hash."""
    return F.translate(
        F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")),
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz",
    )


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, winning, side): paths most pages that have them vote for, best first, and those most do not."""
    bound_batches(pages.sparkSession)

    def vote(batches):
        for batch in batches:
            tally: dict[tuple[str, str], list[int]] = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                parts = blocks(page or "")
                weight = weights(parts)
                own = best_container(parts, weight)
                if own is None:
                    continue
                for path in weight:
                    counts = tally.setdefault((host, PATH_MARK.join(path)), [0, 0])
                    counts[0] += path == own
                    counts[1] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in tally], pa.string()), pa.array([p for _, p in tally], pa.string()),
                 *(pa.array([c[i] for c in tally.values()], pa.int64()) for i in (0, 1))],
                names=["host", "path", "votes", "seen"],
            )

    counted = stage(
        pages.select(host_of(F.col("url")).alias("host"), "html")
        .mapInArrow(vote, "host string, path string, votes bigint, seen bigint")
        .groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("seen").alias("seen"))
        .filter("votes > 0"),
        "ballots",
    )
    cast = counted.groupBy("host").agg(F.sum("votes").alias("cast")).withColumnRenamed("host", "_of")
    # Sums of a host's votes bound the paths kept by 1 / PATH_SHARE winning ones, each voted for.
    kept = counted.join(cast, F.col("host") == F.col("_of")).filter(
        F.when(F.col("votes") * 2 > F.col("seen"), F.col("votes")).otherwise(F.col("seen")) >= PATH_SHARE * F.col("cast")
    )
    wins = F.col("votes") * 2 > F.col("seen")
    listed = F.array_sort(F.collect_list(F.when(wins, F.struct((-F.col("votes")).alias("place"), "path"))))
    return kept.groupBy("host").agg(
        F.transform(listed, lambda x: x["path"]).alias("winning"),
        F.collect_list(F.when(~wins, F.col("path"))).alias("side"),
    )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and the path used, of every row of ``pages``."""
    own = pages.select("page_id", "url", "html")
    known = stage(host_paths(own), "paths").withColumnRenamed("host", "_host")
    met = own.join(broadcast_if_small(known), host_of(F.col("url")) == F.col("_host"), "left").select(
        "page_id", "url", "html", "winning", "side"
    )
    kind = dict(pages.dtypes)["page_id"]

    def run(batches):
        for batch in batches:
            made, used = [], []
            columns = (batch.column(n).to_pylist() for n in ("html", "winning", "side"))
            for page, winning, side in zip(*columns):
                parts = blocks(page or "")
                path = chosen(parts, winning or [], side or [])
                made.append(rendered(parts, path))
                used.append(PATH_MARK.join(path) if path else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(made, pa.string()),
                 pa.array([len(t) for t in made], pa.int64()), pa.array(used, pa.string())],
                names=["page_id", "url", "text", "n_chars", "path"],
            )

    return met.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint, path string")
