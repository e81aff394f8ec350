"""Main text of web pages by consensus host paths.

Every page's containers are scored by the running text in them; the page votes for the path of its best one, a path of tags and classes with
digits set to zero. Votes are counted by host and path in Spark, and the page's text is then taken again from the container that its host's winning
path names, so that a page with hardly any text of its own, or with a long notice, follows the pages beside it.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from locusmill.llm.common import written
from locusmill.llm.words import slices

#: Elements without content, with raw content, whose text is never shown as article text, that begin a block, and that can hold an article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset("nav footer aside form button select dialog menu svg object audio video canvas map datalist".split())
BLOCKS = frozenset("html body div section article main header footer nav aside form fieldset p h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd menu blockquote pre address figure figcaption details summary table caption thead tbody tfoot tr td th hr center dialog".split())
CONTAINERS = frozenset("html body div section article main td th center table blockquote header".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in classes, ids and roles of what isn't the article, and of what is.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsored sponsors promo promos promotion promoted nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager "
    "footer masthead topbar sidebar sidebars aside widget widgets related recommended recommendations trending teaser teasers cookie cookies consent gdpr notice notices alert alerts disclaimer popup modal overlay toast paywall "
    "adslot adbox adunit adcontainer adwrapper cookiebar cookiebanner pagefooter sitefooter siteheader pageheader subnav topnav mainnav usercomments commentform commentbox "
    "newsletter subscribe subscription signup login search comment comments commentlist disqus respond reply replies discussion reactions share sharing social toolbar copyright complementary contentinfo hidden".split()
)
ARTICLE = frozenset("article post entry content story main body text".split())
#: A closing tag is implied: what a start tag of this kind closes, up to the nearest of the listed barriers.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
#: Levels of a path, and paths of a host, the best first; a page without any of them uses its own best container.
DEPTH, PATHS = 12, 8

MARKUP = re.compile(r"""<(?:!--(?:-?>|.*?--!?>|.*\Z)|(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^"'>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+)(?:>|\Z))""", re.S)
ATTRIBUTE = re.compile(r"""(?<!\S)(class|id|role|itemprop|hidden|aria-hidden|style)(?=[\s=>/]|\Z)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
DIGITS = re.compile(r"\d+")


@dataclass
class Container:
    path: str
    parent: int
    bonus: float
    score: float = 0.0


@dataclass
class Page:
    containers: list[Container] = field(default_factory=lambda: [Container("", -1, 1.0)])
    #: container and text of each block, in page order
    blocks: list[tuple[int, str]] = field(default_factory=list)


def _words(name: str) -> set[str]:
    return {w.lower() for w in NAME.findall(name)}


def _traits(tag: str, attributes: str) -> tuple[bool, bool, float, str]:
    """Whether an element isn't the article, whether it is a header, its weight as a container, and its step in a path."""
    found = {k.lower(): (a or b or c or "") for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes else {}
    names = [n for k in ("class", "id", "role") for n in found.get(k, "").split()]
    words = [_words(n) for n in names]
    top = tag in ("html", "body", "main")
    beside = tag in DROPPED or not top and ("hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I)))
    said = [w for n, w in zip(names, words) if not re.match(r"(has|no|not|with|without|is)[-_]", n, re.I)]
    beside = beside or not top and any(w & BESIDE for w in said)
    header = tag == "header" or not top and any("header" in w for w in said)
    bonus = (1.5 if tag in ("article", "main") or found.get("role", "").lower() == "main" or "articleBody" in found.get("itemprop", "") else 1.0) * (1.25 if any(w & ARTICLE for w in words) else 1.0)
    classes = sorted({DIGITS.sub("0", n.lower()) for n in found.get("class", "").split()})
    own_id = f"#{DIGITS.sub('0', found['id'].lower())}" if found.get("id") else ""
    return beside, header, bonus, tag + "".join(f".{c}" for c in classes) + own_id


def parse(text: str) -> Page:
    """The page's blocks of article-like text with their containers, in one pass. Tags that are left open or close nothing are passed over as browsers do."""
    page = Page()
    # an open element: tag, container, whether its text is left out, whether headings alone count, whether it is in an article, in a link, a heading
    stack = [("", 0, False, False, False, False, False)]
    run: list[str] = []
    linked: list[str] = []

    def flush() -> None:
        if not run:
            return
        said, of = " ".join("".join(run).split()), stack[-1][1]
        if said:
            page.blocks.append((of, said))
            weight = 0 if stack[-1][6] else max(0, len(said) - 2 * len("".join(linked)))
            while of >= 0 and weight > 0.5:
                page.containers[of].score += weight
                of, weight = page.containers[of].parent, weight * 0.8
        run.clear()
        linked.clear()

    def close(to: int) -> None:
        if any(e[0] in BLOCKS for e in stack[to:]):
            flush()
        del stack[to:]

    def heard(s: str) -> None:
        _, _, out, only_headings, _, link, heading = stack[-1]
        if s and not out and (heading or not only_headings):
            s = references.unescape(s) if "&" in s else s
            run.append(s)
            if link:
                linked.append(s)

    at, end = 0, len(text)
    while at < end:
        m = MARKUP.search(text, at)
        if not m:
            heard(text[at:])
            break
        heard(text[at : m.start()])
        at, tag = m.end(), (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in RAW:
            ended = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(text, at)
            at = ended.end() if ended else end
            continue
        if tag == "br":
            heard(" ")
        if tag in BLOCKS:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p":
                    close(k)
                elif stack[k][0] in BLOCKS:
                    break
            flush()
        if tag in CLOSES:
            closed, barriers = CLOSES[tag]
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in barriers:
                    break
                if stack[k][0] in closed:
                    close(k)
        if tag in VOID:
            continue
        _, of, out, only, inside, link, heading = stack[-1]
        beside, header, bonus, step = _traits(tag, m[3]) if m[3] or tag in BLOCKS or tag in DROPPED or tag in CONTAINERS else (False, False, 1.0, tag)
        out = out or beside
        if header and not out:
            out, only = not inside, True
        if tag in CONTAINERS and not out:
            parent = page.containers[of]
            page.containers.append(Container(">".join([*parent.path.split(">")[-DEPTH + 1 :], step]) if parent.path else step, of, bonus))
            of = len(page.containers) - 1
        if tag == "h1" and not out:
            page.containers[of].bonus *= 1.3
        inside = inside or tag in ("article", "main") or bonus > 1
        stack.append((tag, of, out, only, inside, link or tag == "a", heading or tag in HEADINGS))
    flush()
    for c in page.containers:
        c.score *= c.bonus
    return page


def best(page: Page, path: str | None = None) -> int:
    """The container of highest score, the first of equal ones; ``path``: among those of this path. -1 without any."""
    of = [k for k, c in enumerate(page.containers) if path is None or c.path == path]
    return max(of, key=lambda k: (page.containers[k].score, -k), default=-1)


def text_of(page: Page, container: int) -> str:
    """The blocks below a container, one a line."""
    below = {container}
    for k, c in enumerate(page.containers):  # parents come first
        if c.parent in below:
            below.add(k)
    return "\n".join(t for of, t in page.blocks if of in below)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "html", mb=16):
        votes: dict[tuple[str, str], list[int]] = {}
        for host, text in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            page = parse(text)
            c = page.containers[best(page)]
            if c.score > 0:
                v = votes.setdefault((host, c.path), [0, 0])
                v[0] += 1
                v[1] += int(c.score)
        keys, sums = list(votes), list(votes.values())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([v[0] for v in sums], pa.int64()), pa.array([v[1] for v in sums], pa.int64())], ["host", "path", "votes", "score"])


def host_paths(pages: DataFrame) -> DataFrame:
    """``pages`` (host, html; both not null) to the paths of each host that got most votes: host, paths (the first wins; equal votes: higher score, then the path).

    A batch sends a row for each host and path in it. The ranks' window is limited to its first rows before the shuffle, so a hot host stays small.
    """
    votes = pages.select("host", "html").mapInArrow(_votes, "host string, path string, votes long, score long").groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))
    ranked = votes.withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), F.desc("score"), "path"))).filter(F.col("rank") <= PATHS)
    return ranked.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"]).alias("paths"))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "html", mb=16):
        texts = []
        for paths, text in zip(b.column("paths").to_pylist(), b.column("html").to_pylist()):
            page = parse(text or "")
            known = {c.path for c in page.containers}
            path = next((p for p in paths or () if p in known), None)
            texts.append(text_of(page, best(page, path)))
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["row", "text", "n_chars"])


def extract_main_text(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``text``, its article's blocks one a line, and ``n_chars``, in place of ``html``; columns of these two names are replaced, others stay.

    Null and empty pages have an empty text. Pages whose url is null or names no host vote for nobody and use their own best container, as does a page
    without any of its host's paths. Repeated rows vote once each. Links inside an element whose tag, class, id or role marks it as menu, footer, sidebar, notice, advert, form or
    comment are left out with it; of a header inside the article the headings stay. A list's item and a table's cell are blocks, a ``<br>`` is white space.
    The hosts' paths are a written table: Spark broadcasts it if its files are small, else the pages are joined by host and a hot host's share is split.
    """
    host = F.lower(F.regexp_extract(F.col(url), r"^.*?://([^/?#]*)", 1))
    named = pages.select(host.alias("host"), F.col(html).alias("html")).filter("host <> '' AND html <> ''")
    paths = written(host_paths(named), "host-paths")
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    rows = pages.select(F.struct(*kept).alias("row"), F.col(html).alias("html"), host.alias("host")).join(paths, "host", "left").select("row", "html", "paths")
    schema = StructType([rows.schema["row"], StructField("text", StringType()), StructField("n_chars", LongType())])
    return rows.mapInArrow(_extracted, schema).select("row.*", "text", "n_chars")


def op11_host_paths(pages: DataFrame) -> DataFrame:
    """The contract's query."""
    return extract_main_text(pages.select("page_id", "url", "html"))
