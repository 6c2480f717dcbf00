"""Main text of web pages by consensus host paths.

A page is read into blocks of text, each with its path of containers. A
container is named by its tag and its generalised classes (lower-cased, digits
and everything after them left out), so the same template gives the same path
on every page. Each page scores its containers by the prose in them; per host
the scores vote on paths in Spark, and the pages are read again with their
host's winning path. Where that path is missing, or the page's best container lies
elsewhere and the path holds little beside it, the best container is used;
where the best container encloses the path, its other prose stays, too, but for
containers that most pages of the host have beside the path.

Menus, headers, footers, side bars, notices, adverts, forms, comments, scripts
and styles are known by tag, role or class and never count."""
from __future__ import annotations

import hashlib
import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import map_batches, only
from .url_filter import split_url

PATH_DEPTH = 32          # innermost containers named in a path; a hash stands for the others
MIN_SHARE = 0.3          # of the score of a best container elsewhere, for the host's path to win

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg annotation annotation-xml select "
                "textarea canvas video audio button noframes title head".split())
UNSEEN = frozenset("script style noscript template annotation annotation-xml title "
                   "noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article body center dd div main section td".split())
OUT_TAGS = frozenset("nav header footer aside form menu dialog".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar "
                      "dialog alert alertdialog toolbar".split())
CLOSES_P = BLOCKS - {"html", "body", "caption", "legend", "option", "optgroup", "summary", "tbody",
                     "td", "tfoot", "th", "thead", "tr"}
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
            "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
            "thead": ("tbody", "tfoot"), "tbody": ("thead", "tbody", "tr", "td", "th"),
            "tfoot": ("thead", "tbody", "tr", "td", "th")}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
          "td": ("table", "tr"), "th": ("table", "tr"), "option": ("select",),
          "thead": ("table",), "tbody": ("table",), "tfoot": ("table",)}
# Words of class and id names, as whole parts of a name. The second list only
# counts where the name has no word of the third.
OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs masthead topbar footer bottombar sidebar "
    "sidebars aside related recommended recommendations cookie cookies consent gdpr notice notices "
    "alert popup modal overlay newsletter subscribe subscription signup sharing social comments "
    "comment commentlist disqus respond replies discussion pagination pager toolbar searchform "
    "tagcloud".split())
WEAK_OUT_WORDS = frozenset("banner form header login promo promotion rail reply search share skip "
                           "tags widget widgets".split())
KEEP_WORDS = frozenset("article body content entry post story".split())
LAYOUT_WORDS = frozenset("free has no with without".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[a-z]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW}


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "")
            for m in _ATTRIBUTE.finditer(source)} if source.strip(" /") else {}


def generalised(tag: str, names: str) -> str:
    """Tag and classes without digits: ``div.post-1234`` becomes ``div.post``."""
    kept = []
    for name in names.lower().split():
        name = re.split(r"\d", name, maxsplit=1)[0].strip("-_")
        if name and name not in kept:
            kept.append(name)
    return ".".join([tag, *sorted(kept)])


def longer(path: str, name: str) -> str:
    """The path with one container more. Of a deep one the outer containers are
    folded into a hash, so different paths stay different and all are short."""
    chain = [*path.split(">"), name]
    if len(chain) > PATH_DEPTH:
        chain[:2] = ["#" + hashlib.md5(">".join(chain[:2]).encode()).hexdigest()]
    return ">".join(chain)


def is_out(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    if tag in OUT_TAGS and not (tag == "header" and inside_article):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in OUT_ROLES or "hidden" in attributes \
            or attributes.get("aria-hidden", "").lower() == "true" \
            or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    for name in (attributes.get("class", "") + " " + attributes.get("id", "")).split():
        words = set(_PARTS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower()))
        if not words & LAYOUT_WORDS and (
                words & OUT_WORDS or words & WEAK_OUT_WORDS and not words & KEEP_WORDS):
            return True
    return False


class Page:
    """Blocks of text outside of menus and the like, each with the chain of
    container numbers around it; containers know their parent and path."""

    def __init__(self, source: str):
        self.parents = [-1]
        self.paths = ["html"]
        self.blocks: list[tuple[int, str, int]] = []    # container, text, linked characters
        self.titles: set[int] = set()                   # blocks that are first-level headings
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int, bool]] = [("html", 0, False)]   # tag, container, out
        text: list[str] = []
        linked = 0
        links = 0

        def end_block() -> None:
            nonlocal linked
            if text:
                block = _SPACE.sub(" ", html.unescape("".join(text))).strip()
                if block and not stack[-1][2]:
                    if stack[-1][0] == "h1":
                        self.titles.add(len(self.blocks))
                    self.blocks.append((stack[-1][1], block, min(linked, len(block))))
                text.clear()
            linked = 0

        def close(until: int) -> None:
            nonlocal links
            while len(stack) > until:
                if stack[-1][0] in BLOCKS:
                    end_block()
                links -= stack[-1][0] == "a"
                stack.pop()

        at = 0
        while True:
            m = _TOKEN.search(source, at)
            piece = source[at:m.start() if m else len(source)]
            if piece and not stack[-1][2]:
                text.append(piece)
                if links:
                    linked += len(piece)
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA[") and not stack[-1][2]:
                    text.append(html.escape(m[0][9:].removesuffix("]]>"), quote=False))
                continue
            if m[1]:
                if tag == "br" or tag == "p" and not any(s[0] == "p" for s in stack):
                    end_block() if tag == "p" else text.append(" ")
                    continue
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        close(i)
                        break
                    # An inline end tag doesn't close the blocks around it.
                    if tag not in BLOCKS and stack[i][0] in BLOCKS:
                        break
                continue
            if tag in RAW:
                attributes_end = m[3].rstrip().endswith("/") and tag == "svg"
                if tag == "head":
                    continue
                if not attributes_end:
                    stop = _RAW_END[tag].search(source, at)
                    if stop:
                        at = stop.end()
                    elif tag in UNSEEN or tag in ("textarea", "iframe"):
                        at = len(source)
                if tag not in UNSEEN:
                    text.append(" ")
                continue
            if tag in VOID:
                if tag == "hr":
                    end_block()
                elif tag in ("br", "wbr", "img"):
                    text.append("" if tag == "wbr" else " ")
                continue
            if tag in CLOSES_P:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == "p":
                        close(i)
                        break
                    if stack[i][0] in ("table", "td", "th", "button", "article", "section", "div"):
                        break
            for i in range(len(stack) - 1, 0, -1) if tag in SIBLINGS else ():
                if stack[i][0] in SIBLINGS[tag]:
                    close(i)
                    if tag != "tr" or stack[-1][0] not in SIBLINGS[tag]:
                        break
                elif stack[i][0] in SCOPES[tag]:
                    break
            if tag in BLOCKS:
                end_block()
            attributes = _attributes(m[3])
            _, container, out = stack[-1]
            out = out or is_out(tag, attributes, any(s[0] in ("article", "main") for s in stack))
            if tag in CONTAINERS and not out:
                self.parents.append(container)
                self.paths.append(longer(self.paths[container],
                                         generalised(tag, attributes.get("class", ""))))
                container = len(self.paths) - 1
            if tag == "body" and not out:
                stack[0] = ("html", container, False)
                continue
            if tag != "html":
                links += tag == "a"
                stack.append((tag, container, out))
        close(1)
        end_block()

    def scores(self) -> list[float]:
        """Prose of each container: a block counts by its characters outside of
        links, whole for its own container and a little less for each one
        around it; elements and names made for articles count for more."""
        score = [0.0] * len(self.paths)
        for container, block, linked in self.blocks:
            prose = len(block) - 2 * linked
            while container >= 0:
                score[container] += prose
                container = self.parents[container]
                prose *= .95
        for i, path in enumerate(self.paths):
            tag, *names = path.rpartition(">")[2].split(".")
            score[i] *= 1.5 if tag == "article" else 1.25 if tag == "main" else 1.15 \
                if any(KEEP_WORDS & set(_PARTS.findall(n)) for n in names) else 1
        return score

    def inside(self, chosen: set[int]) -> list[bool]:
        held = [False] * len(self.paths)
        for i, parent in enumerate(self.parents):
            held[i] = i in chosen or parent >= 0 and held[parent]
        return held

    def text(self, chosen: set[int] | None, around: int | None = None,
             usual: frozenset[str] = frozenset()) -> str:
        """Blocks inside any of the chosen containers and, outside of usual
        paths, prose in the one around them, in page order, with a title that
        stands right before."""
        if chosen is None:
            return "\n\n".join(b for _, b, _ in self.blocks)
        held = self.inside(chosen)
        near = [i == around for i in range(len(self.paths))]
        for i, parent in enumerate(self.parents if around is not None else ()):
            near[i] |= parent >= 0 and near[parent] and self.paths[i] not in usual
        at = [i for i, (c, block, linked) in enumerate(self.blocks)
              if held[c] or near[c] and 2 * linked < len(block)]
        if at and at[0] - 1 in self.titles:
            at.insert(0, at[0] - 1)
        return "\n\n".join(self.blocks[i][1] for i in at)


def best_text(page: Page, path: str | None, usual: frozenset[str] = frozenset()) -> str:
    """The text under the host's path, with the other prose of the page's best
    container where that encloses the path (not that under usual paths). If the best container lies
    elsewhere, the path has to hold ``MIN_SHARE`` of its score; else, and
    without the path, the best container's text."""
    if not page.blocks:
        return ""
    score = page.scores()
    best = max(range(len(score)), key=lambda i: (score[i], i))
    if score[best] <= 0:
        return page.text(None)
    voted = {i for i, p in enumerate(page.paths) if p == path}
    held = page.inside(voted)
    outer = {i for i in voted if page.parents[i] < 0 or not held[page.parents[i]]}
    around = page.inside({best})
    if outer and not held[best] and all(around[i] for i in outer):
        return page.text(outer, best, usual)
    if outer and sum(score[i] for i in outer) >= MIN_SHARE * score[best]:
        return page.text(outer)
    return page.text({best})


def extract_text(df: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per input row: ``page_id, url, text, n_chars, host_path``.

    A null or empty page has an empty text. Pages without a host vote and are
    read under the empty host. Repeated rows are read each and vote each; an
    empty table gives no rows. ``host_path`` is the winning path of the page's
    host (null if no page of it has any prose). Votes are summed per host and
    path before they are shuffled, so a host with most of the pages costs one
    row per path and task; the winner per host is joined back, with the paths
    beside it that more than half of the pages have (at most twice as many as a
    page has containers on average)."""
    scratch = scratch or Scratch(df.sparkSession)
    pages = only(df, page_id="bigint", url="string", html="string")

    def vote(part: pa.RecordBatch, _):
        sums: dict[tuple[str, str], list] = {}
        for url, source in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
            page = Page(source or "")
            per_path: dict[str, float] = {}
            for path, score in zip(page.paths, page.scores()):
                if score > 0:
                    per_path[path] = per_path.get(path, 0) + score
            top = max(per_path.values(), default=1)
            for path, score in per_path.items():    # by its share of the page's best
                share = score / top
                have = sums.setdefault((split_url(url)[0], path), [0, 0])
                have[0] += math.floor(share ** 4 * 1_000_000)
                have[1] += 1
        return {"host": [h for h, _ in sums], "path": [p for _, p in sums],
                "votes": [v for v, _ in sums.values()], "pages": [n for _, n in sums.values()]}

    votes = scratch.table(
        map_batches(pages, vote, "host string, path string, votes bigint, pages bigint", text="html")
        .groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("pages").alias("pages")))
    # The most votes win; of equal paths the deeper, then the first by name.
    depth = F.size(F.split("path", ">"))
    winners = votes.groupBy("host").agg(
        F.min_by("path", F.struct(-F.col("votes"), -depth, "path")).alias("host_path"),
        F.max("pages").alias("most"))
    # Containers around or inside the winning path are not beside it.
    beside = ~(F.startswith(F.concat("host_path", F.lit(">")), F.concat("path", F.lit(">")))
               | F.startswith(F.concat("path", F.lit(">")), F.concat("host_path", F.lit(">"))))
    usual = F.when(beside & (2 * F.col("pages") > F.col("most")), F.col("path"))
    winners = scratch.table(votes.select("host", "path", "pages").join(winners, "host")
                            .groupBy("host").agg(F.first("host_path").alias("host_path"),
                                                 F.collect_list(usual).alias("usual")))
    scratch.drop(votes)
    rest = F.when(F.instr("url", "://") > 0, F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)", 1))
    host = F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    joined = (pages.withColumn("host", host).join(winners, "host", "left")
              .select("page_id", "url", "html", "host_path", "usual"))

    def read(part: pa.RecordBatch, _):
        texts = [best_text(Page(source or ""), path, frozenset(usual or ())) for
                 source, path, usual in zip(*(part.column(i).to_pylist() for i in (2, 3, 4)))]
        return {"page_id": part.column(0), "url": part.column(1), "text": texts,
                "n_chars": [len(t) for t in texts], "host_path": part.column(3)}

    return map_batches(joined, read, "page_id bigint, url string, text string, n_chars bigint, "
                                     "host_path string", text="html")
