"""Main text of web pages by paths that a host's pages agree on.

1. Every page's containers are scored (text of their blocks, links not counted);
   the best one votes for its generalised path: tags and classes from the root,
   digits replaced.
2. The votes are counted per host in Spark; the path with most votes wins.
3. Every page is read again and the text of its elements on the winning path is
   its main text; a page without such an element falls back to its own best.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out inside the chosen element as well.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of, kept, kept_fields, map_batches, named, refuse_clashes, stored, with_fields
from quillspark.llm.url_filter import host_of

#: Bytes of hosts and winning paths that are broadcast at most; more are joined by shuffling.
BROADCAST_BYTES = 32 << 20
BATCH_BYTES = 4 << 20

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe svg object".split())
_DROPPED = frozenset("nav header footer aside form button select fieldset dialog menu".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split())
_CONTAINER = frozenset("html body article main section div td center".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words in classes and ids of what isn't the article.
_COMMENTS = frozenset("comment comments disqus replies respond commentlist".split())
_ASIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion banner sidebar widget widgets nav navbar navigation menu menus breadcrumb breadcrumbs header masthead footer notice notices cookie cookies consent gdpr alert popup modal newsletter subscribe subscription signup login share sharing social related recommended recommendations pagination pager".split()
)
_NEGATED = frozenset("no has with without hide show is".split())
_CLOSED_BY = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}


def _marked(tag: str, attributes: str) -> tuple[bool, str]:
    """(is it left out, its classes in general form)."""
    words, classes, role = set(), "", ""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if name == "role":
            role = value.strip().lower()
            continue
        if name == "class":
            classes = ".".join(sorted({re.sub(r"\d+", "#", k) for k in value.lower().split()}))
        for part in value.lower().split():
            bits = re.split(r"[^a-z]+", part)
            words |= {w for before, w in zip(["", *bits], bits, strict=False) if w and before not in _NEGATED}
    if role in _ROLES or words & _COMMENTS:
        return True, classes
    return bool(words & _ASIDE) and tag not in ("article", "main", "body", "html"), classes


class Page:
    """Containers with their paths and the text blocks below them, in page order."""

    def __init__(self, source: str):
        self.paths: list[str] = []  # of containers
        self.parents: list[int] = []
        self.lifts: list[int] = []  # a container's outermost article or main, else itself
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters outside links
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack: list[tuple[str, str, int, bool]] = [("", "", -1, False)]  # tag, path, container, left out
        self._container("", -1, "")
        text: list[str] = []
        linked = links = 0
        at, search, lower = 0, _TOKEN.search, None

        def flush() -> None:
            nonlocal text, linked
            if text:
                block = " ".join(html_lib.unescape("".join(text)).split())
                if block:
                    self.blocks.append((max(stack[-1][2], 0), block, max(0, len(block) - linked)))
                text = []
            linked = 0

        while True:
            m = search(source, at)
            piece = source[at : m.start() if m else len(source)]
            if piece and not stack[-1][3]:
                text.append(piece)
                if links:
                    linked += len(piece)
            if m is None:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if tag in _RAW:
                if not closing and not m[3].endswith("/"):
                    lower = lower or source.lower()
                    end = lower.find(f"</{tag}", at) if len(lower) == len(source) else -1
                    if end < 0:
                        found = re.compile(f"</{tag}", re.I).search(source, at)
                        end = found.start() if found else len(source)
                    stop = source.find(">", end)
                    at = len(source) if stop < 0 else stop + 1
                continue
            if tag == "br":
                text.append(" ")
                continue
            if tag == "a":
                links = 0 if closing else 1
            block = tag in _BLOCK
            if block:
                flush()
            if closing:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
                    if not block and stack[k][0] in _BLOCK:
                        break  # a stray end of an inline element closes no block
                continue
            if tag in _VOID:
                continue
            if block:
                self._imply(stack, tag)
            out, classes = _marked(tag, m[3]) if m[3] else (False, "")
            if m[3].endswith("/") and not block:
                continue
            _, path, container, left_out = stack[-1]
            left_out = left_out or out or tag in _DROPPED
            if block:
                path = f"{path}>{tag}.{classes}" if classes else f"{path}>{tag}"
            if tag in _CONTAINER and not left_out:
                container = self._container(path, container, tag)
            stack.append((tag, path, container, left_out))
        flush()

    @staticmethod
    def _imply(stack: list, tag: str) -> None:
        """End tags that a block element's start implies: of an open p, or of an item of the same kind."""
        for k in range(len(stack) - 1, 0, -1):
            open_tag = stack[k][0]
            if open_tag == "p":
                del stack[k:]
                break
            if open_tag in _BLOCK:
                break
        limits = _CLOSED_BY.get(tag)
        if limits:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in limits:
                    break
                if stack[k][0] == tag or {stack[k][0], tag} in ({"dt", "dd"}, {"td", "th"}):
                    del stack[k:]
                    break

    def _container(self, path: str, parent: int, tag: str) -> int:
        own = len(self.paths)
        self.paths.append(path)
        self.parents.append(parent)
        above = self.lifts[parent] if parent >= 0 else own
        inside = parent >= 0 and above != parent or (parent >= 0 and self._main(parent))
        self.lifts.append(above if inside else own)
        return own

    def _main(self, k: int) -> bool:
        return re.match(r"(?:article|main)(?:\.|$)", self.paths[k].rpartition(">")[2]) is not None

    def best(self) -> int:
        """The container with the highest score; the text of blocks counts in full for their container, by half for the one above."""
        score: Counter = Counter()
        for k, block, own in self.blocks:
            worth = own if len(block) > 25 else own / 4
            score[k] += worth
            if self.parents[k] >= 0:
                score[self.parents[k]] += worth / 2
        if not score:
            return 0
        return self.lifts[max(score, key=lambda k: (score[k], -k))]

    def text_of(self, path: str | None) -> str:
        """Blocks below all elements on the path; below the page's best container if there is none, or no text in them."""
        chosen = {k for k, p in enumerate(self.paths) if p == path} if path is not None else set()
        out = self._below(chosen) if chosen else []
        return "\n".join(out or self._below({self.best()}))

    def _below(self, chosen: set[int]) -> list[str]:
        inside = [False] * len(self.paths)
        for k, parent in enumerate(self.parents):  # a parent comes before its children
            inside[k] = k in chosen or (parent >= 0 and inside[parent])
        return [block for k, block, _ in self.blocks if inside[k]]


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches_of(batches, "html", BATCH_BYTES):
        votes: Counter = Counter()
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if host and source:
                page = Page(source)
                if page.blocks:
                    votes[host, page.paths[page.best()]] += 1
        yield pa.RecordBatch.from_pydict({"host": [k[0] for k in votes], "path": [k[1] for k in votes], "votes": list(votes.values())}, schema=pa.schema([("host", pa.string()), ("path", pa.string()), ("votes", pa.int64())]))


def extract(df: DataFrame, html_col: str = "html", url_col: str = "url", keep: list[str] | None = None, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row: the columns ``keep``, main_text and main_path (the path it was taken from; null without a host).

    Character references are decoded, white space in a block becomes one space,
    blocks are joined by a newline.  Null and empty pages and pages of markup alone
    have an empty text; a null URL or one without a host has no vote and takes its
    own best container.  Ties in votes go to the first path in order.  Repeated rows
    each get theirs (and vote each); empty tables give no rows.  Columns that aren't
    kept may have any name; one of ``keep`` that is named like an output is an error.
    """
    keep = [] if keep is None else keep
    refuse_clashes(keep, "main_text", "main_path")
    rows = df.select(*kept(df, keep), df[html_col].cast("string").alias("__html"), host_of(df[url_col].cast("string")).alias("__host"))
    votes = map_batches(rows.select(F.col("__host").alias("host"), F.col("__html").alias("html")), _vote, "host string, path string, votes long")
    counted = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    # The least path of those with the most votes: one more aggregate, no window.
    top = stored(counted.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("v"), "path")).alias("x")).select(F.col("host").alias("__host"), F.col("x.path").alias("main_path")), "paths")
    size = top.agg(F.sum(F.octet_length("__host") + F.octet_length("main_path") + 32)).first()[0] or 0
    side = F.broadcast(top) if size <= broadcast_bytes else top
    joined = rows.join(side, "__host", "left").drop("__host")
    fields = kept_fields(joined)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_of(batches, "__html", BATCH_BYTES):
            texts = [Page(source).text_of(path) if source else "" for source, path in zip(batch.column("__html").to_pylist(), batch.column("main_path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(texts, pa.string()), batch.column("main_path")], names=[*(f.name for f in fields), "main_text", "main_path"])

    return named(map_batches(joined, run, with_fields(fields, "main_text string, main_path string")), keep, "main_text", "main_path")


def op9_html_text(spark, sf_dir: str) -> DataFrame:
    """Query: the main text of every page."""
    out = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), keep=["page_id", "url"])
    return out.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))
