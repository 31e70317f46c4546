"""Main text of web pages by a consensus of each host's pages.

Pass 1 parses every page, scores its containers (elements that hold blocks of text) and votes for the paths of those that
hold the article: the tags and class words from the root, with digits generalised and repeated siblings alike. From the best
container a page climbs while the text around it belongs to it, and takes in neighbours of a like size. Spark adds the votes
up by host, pre-aggregated before the shuffle; a host's paths are the one with the most votes and all that most of its
pages name. Pass 2 parses the pages again and takes the text of the containers at these paths. A page without any of them
falls back on its own.

The scanner goes over a page once: tags end at a mark found ahead and remembered, open elements are kept in stacks, and
paths are numbers. Broken markup takes no longer than any other.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import col, free_name, is_small, keep_table, prepare, text_of

#: A tag without odd quotes. Quantifiers don't give back, and none looks beyond the next "<".
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><\"'=]*+)((?:[^><\"']++|=\"[^\"<>]{0,400}+\"|='[^'<>]{0,400}+'|(?<==)\"[^\"<>]{0,400}+\"|(?<==)'[^'<>]{0,400}+')*+)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/><\"'=]*+)")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++))", re.I)
_WORDS = re.compile(r"[a-z]+")
#: Elements whose content is no text of the page.
_SKIPPED = frozenset("script style noscript template textarea iframe select".split())
_SKIP_TO = {tag: re.compile(f"</{tag}(?=[\\s/>])[^>]*+>?", re.I) for tag in _SKIPPED}

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
#: An open p ends where one of these begins.
ENDS_P = BLOCK - {"body", "html", "head", "title", "option", "caption"}
CONTAINER = frozenset("article body blockquote center dd div main section table tbody td tr ul ol dl".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROP_TAGS = frozenset("nav footer aside form menu button head title dialog".split())
DROP_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments consent "
    "cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted promotion related replies reply share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription toolbar widget".split()
)
#: Words that say nothing about what an element holds: beside one of DROP_WORDS in a class they don't speak for it.
PLAIN_WORDS = frozenset(
    "a area articles aside bar block body bottom box btn button buttons card cards col column container content form group "
    "heading icon icons id inner item items js large layout left level link links list main module more outer overlay page "
    "panel policy post posts primary region right row secondary section site slot small sticky tag tags text thread title top "
    "ui unit user view warning wrap wrapper zone".split()
)
DROP_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
GOOD = {"article": 1.5, "main": 1.4, "section": 1.0, "div": 1.0, "td": 0.9, "body": 0.6}
#: No article climbs beyond these.
TOPS = frozenset("body html article main table tbody tr td".split())
#: Text around the best container belongs to it from this share of its letters on; so do neighbours, of a larger share.
AROUND, BESIDE = 0.15, 0.25

KEEP, DOUBT, DROP = 0, 1, 2


class Block:
    """A run of text with its place: the innermost container, whether it is dropped, the outermost doubtful element around it
    (or -1), whether it is a heading, and how much of it is in links."""

    __slots__ = ("inside", "dropped", "doubt", "heading", "parts", "linked", "length")

    def __init__(self, inside: int, dropped: bool, doubt: int, heading: bool) -> None:
        self.inside, self.dropped, self.doubt, self.heading = inside, dropped, doubt, heading
        self.parts, self.linked, self.length = [], 0, 0

    def text(self) -> str:
        return " ".join(unescape("".join(self.parts)).split())


def _described(tag: str, attributes: str) -> tuple[str, int]:
    """The element's step in a path, and whether what it holds is part of an article. A word of DROP_WORDS decides where it is
    a class word or id by itself or stands among words that say nothing; beside other words it only raises doubt."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    step = re.sub(r"\d+", "#", " ".join(found.get("class", "").replace(">", "").split()))
    drop = DROP if tag in DROP_TAGS or found.get("role", "") in DROP_ROLES else KEEP
    if tag not in ("html", "body", "article", "main"):
        for name in f"{found.get('class', '')} {found.get('id', '')}".split():
            words = _WORDS.findall(name)
            if not DROP_WORDS.isdisjoint(words):
                alone = all(w in DROP_WORDS or w in PLAIN_WORDS for w in words)
                drop = max(drop, DROP if alone else DOUBT)
    return f"{tag}.{step}" if step else tag, drop


class Open:
    """An open element: the container it is or stands in, whether it is dropped, its doubtful ancestor, the number of its
    path, whether it is in a link, an article, a heading; for a block, the inline elements open in it by tag."""

    __slots__ = ("tag", "inside", "drop", "doubt", "path", "link", "article", "heading", "inline")

    def __init__(self, tag, inside=0, drop=False, doubt=-1, path=0, link=False, article=False, heading=False) -> None:
        self.tag, self.inside, self.drop, self.doubt, self.path, self.link = tag, inside, drop, doubt, path, link
        self.article, self.heading, self.inline = article, heading, {}


class Ahead:
    """Where marks stand next. Each is looked for once from where it was found last, so all searches go over the page once."""

    def __init__(self, html: str) -> None:
        self.html, self.found = html, {}

    def next(self, mark: str, at: int) -> int:
        """The next place of a mark from `at` on, -1 if there is none; `at` never falls."""
        known = self.found.get(mark, 0)
        if known == -1 or known > at or (known == at and self.html.startswith(mark, at)):
            return known
        known = self.found[mark] = self.html.find(mark, at)
        return known

    def tag_end(self, at: int) -> int:
        """Where the tag whose name ends at `at` ends: at the next ">" outside of quoted values. A quote that doesn't follow
        "=", or is never closed, is a letter."""
        html = self.html
        while True:
            stop = self.next(">", at)
            if stop < 0:
                return -1
            places = [q for q in (self.next('"', at), self.next("'", at)) if 0 <= q < stop]
            if not places:
                return stop
            quote = min(places)
            before = quote - 1
            while before > at and html[before].isspace():
                before -= 1
            close = self.next(html[quote], quote + 1) if html[before] == "=" else -1
            at = close + 1 if close >= 0 else quote + 1


class Page:
    """A parsed page: its blocks in order; for each container its path's number, its tag and the one around it."""

    def __init__(self, html: str) -> None:
        self.blocks: list[Block] = []
        self.paths, self.tags, self.parent = [0], ["body"], [-1]
        self.steps: dict[tuple[int, str], int] = {}  # the number of the path that a step leads to from another
        self._named: list[tuple[int, str]] = [(-1, "")]
        self._block: Block | None = None
        self._stack, self._deep = [Open("")], [0]  # all open elements, and the places of the blocks among them
        self._count: dict[str, int] = {}
        self._read(html)
        self._settle()

    def _add(self, text: str) -> None:
        top = self._stack[-1]
        if self._block is None:
            if not text.strip():
                return
            self._block = Block(top.inside, top.drop, top.doubt, top.heading)
            self.blocks.append(self._block)
        self._block.parts.append(text)
        self._block.length += len(text)
        if top.link:
            self._block.linked += len(text)

    def _close(self, k: int) -> None:
        """Close the open element at place k and all in it."""
        stack, deep = self._stack, self._deep
        while len(stack) > k:
            gone = stack.pop()
            if gone.tag in BLOCK:
                self._count[gone.tag] -= 1
                deep.pop()
            else:
                stack[deep[-1]].inline[gone.tag] -= 1

    def _end(self, tag: str) -> None:
        """Close the nearest open `tag`. An inline end tag closes nothing outside of the block that it stands in."""
        stack = self._stack
        if tag in BLOCK:
            if self._count.get(tag):
                self._close(next(k for k in reversed(self._deep) if stack[k].tag == tag))
        elif stack[self._deep[-1]].inline.get(tag):
            self._close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))

    def _implied_ends(self, tag: str) -> None:
        """Close what the start of `tag` ends by itself: a p before a block, a list item before the next, the head."""
        again = tag in ("li", "dt", "dd", "tr", "td", "th")
        if tag == "body":
            ended = {"head"}
        elif again or tag == "option":
            ended = {"p", tag} | ({"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th", "tr") else set())
        elif tag in ENDS_P:
            ended = {"p"}
        else:
            return
        while len(self._deep) > 1 and self._stack[self._deep[-1]].tag in ended:
            self._close(self._deep[-1])
            if not again:
                return

    def _start(self, tag: str, step: str, drop: int) -> None:
        if tag in BLOCK:
            self._implied_ends(tag)
        top = self._stack[-1]
        if tag == "header" and drop == KEEP and not top.article:
            drop = DROP  # a page's header; that of an article holds its headline
        new = Open(tag, top.inside, top.drop or drop == DROP, top.doubt, top.path, top.link or tag == "a",
                   top.article or tag in ("article", "main"), top.heading or tag in HEADINGS)
        if drop == DOUBT and new.doubt < 0:
            new.doubt = self._n_doubts
            self._n_doubts += 1
        if tag in BLOCK:
            new.path = self.steps.setdefault((top.path, step), len(self._named))
            if new.path == len(self._named):
                self._named.append((top.path, step))
            self._deep.append(len(self._stack))
            self._count[tag] = self._count.get(tag, 0) + 1
            if tag in CONTAINER:
                new.inside = len(self.paths)
                self.paths.append(new.path)
                self.tags.append(tag)
                self.parent.append(top.inside)
        else:
            inline = self._stack[self._deep[-1]].inline
            inline[tag] = inline.get(tag, 0) + 1
        self._stack.append(new)

    _n_doubts = 0

    def _read(self, html: str) -> None:
        described: dict[tuple[str, str], tuple[str, int]] = {}
        ahead, at, done = Ahead(html), 0, 0  # text up to `done` has been taken
        while (at := html.find("<", at)) >= 0:
            m = _TAG.match(html, at)
            if m:
                end, closing, tag, attributes = m.end(), m[1], m[2].lower(), m[3]
            elif html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                end, tag = (len(html) if end < 0 else end + 3), ""
            elif html.startswith(("<!", "<?"), at):
                end = ahead.next(">", at)
                end, tag = (len(html) if end < 0 else end + 1), ""
            else:
                m = _NAME.match(html, at)
                end = ahead.tag_end(m.end()) + 1 if m else 0
                if not end:
                    at += 1  # a letter like any other
                    continue
                closing, tag, attributes = m[1], m[2].lower(), html[m.end() : end - 1]
            if done < at:
                self._add(html[done:at])
            at = done = end
            if not tag:
                continue
            if tag in BLOCK:
                self._block = None
            if closing:
                self._end(tag)
            elif tag in VOID:
                if tag == "br":
                    self._add(" ")
            elif tag in _SKIPPED:
                close = _SKIP_TO[tag].search(html, end)
                at = done = close.end() if close else len(html)
            else:
                known = described.get((tag, attributes))
                if known is None:
                    known = described[tag, attributes] = _described(tag, attributes)
                self._start(tag, *known)
        if done < len(html):
            self._add(html[done:])

    def _settle(self) -> None:
        """Drop doubtful elements that are links for the most part."""
        length, linked = [0] * self._n_doubts, [0] * self._n_doubts
        for b in self.blocks:
            if b.doubt >= 0:
                length[b.doubt] += b.length
                linked[b.doubt] += b.linked
        for b in self.blocks:
            b.dropped = b.dropped or (b.doubt >= 0 and 2 * linked[b.doubt] >= length[b.doubt])

    def path_of(self, container: int) -> str:
        steps, at = [], self.paths[container]
        while at:
            at, step = self._named[at]
            steps.append(step)
        return "".join(f">{s}" for s in reversed(steps))

    def _numbers(self, paths: Iterable[str]) -> set[int]:
        """The numbers of the paths that this page has."""
        found = set()
        for path in paths:
            at: int | None = 0
            for step in path.split(">")[1:]:
                at = self.steps.get((at, step))
                if at is None:
                    break
            if at is not None:
                found.add(at)
        return found

    def _sums(self, values: list[float]) -> list[float]:
        """Each container's own value and those of all containers in it."""
        total = list(values)
        for k in range(len(total) - 1, 0, -1):
            total[self.parent[k]] += total[k]
        return total

    def best(self) -> tuple[list[str], float]:
        """The paths of the containers that hold the article, and the score of the best. A block counts by its letters
        outside of links, in full for the container that it stands in and by half for each one further out. The winner gives
        way to an article or main around it, or else to containers around it as long as what they add is link-poor and much
        (or a heading of their own); neighbours with enough link-poor text count too."""
        n = len(self.paths)
        scores, letters, linked = [0.0] * n, [0.0] * n, [0.0] * n
        heads = [False] * n
        for b in self.blocks:
            if b.dropped:
                continue
            letters[b.inside] += b.length
            linked[b.inside] += b.linked
            heads[b.inside] |= b.heading
            worth, at = max(0, b.length - 2 * b.linked), b.inside
            while worth >= 1 and at >= 0:
                scores[at] += worth
                worth, at = worth / 2, self.parent[at]
        scores = [s * GOOD.get(t, 0.8) for s, t in zip(scores, self.tags, strict=True)]
        top = max(range(n), key=scores.__getitem__)
        score, up = scores[top], top
        while up > 0:
            if self.tags[up] in ("article", "main"):
                return [self.path_of(up)], score
            up = self.parent[up]
        letters, linked = self._sums(letters), self._sums(linked)
        while self.tags[top] not in TOPS and self.tags[around := self.parent[top]] not in TOPS:
            more, more_linked = letters[around] - letters[top], linked[around] - linked[top]
            if 2 * more_linked > more or more < AROUND * letters[top] and not heads[around]:
                break
            top = around
        paths = {self.path_of(top)}
        if top and self.tags[top] != "body":
            for k in range(1, n):
                beside = self.parent[k] == self.parent[top] and self.tags[k] in ("div", "section", "blockquote")
                if beside and letters[k] >= BESIDE * letters[top] and 4 * linked[k] <= letters[k]:
                    paths.add(self.path_of(k))
        return sorted(paths), score

    def text_at(self, paths: Iterable[str]) -> str | None:
        """The text of all containers at the paths, in page order, but for menus: those that are links for the most part,
        unless all are. None if there is no container."""
        wanted = self._numbers(paths)
        owner = [-1] * len(self.paths)  # the outermost wanted container around each
        for k, path in enumerate(self.paths):
            owner[k] = owner[self.parent[k]] if k and owner[self.parent[k]] >= 0 else k if path in wanted else -1
        owners = set(owner) - {-1}
        if not owners:
            return None
        weight = dict.fromkeys(owners, 0)
        for b in self.blocks:
            if owner[b.inside] >= 0:
                weight[owner[b.inside]] += b.length - 2 * b.linked
        owners = {k for k, w in weight.items() if w >= 0} or owners
        found = (b.text() for b in self.blocks if not b.dropped and owner[b.inside] in owners)
        return "\n".join(t for t in found if t)


def host_of(url: Column) -> Column:
    """The host in lower case; empty where the address has none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1)
    return F.lower(found)


def _best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame([Page(h).best() for h in batch], columns=["paths", "score"])


def _extract(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for html, paths in batches:
        yield pd.Series([page_text(h, p) for h, p in zip(html, paths, strict=True)], dtype=object)


def page_text(html: str, paths: Iterable[str] | None = None) -> str:
    """The text at a host's paths, or where there is none, at the page's own."""
    page = Page(html)
    text = page.text_at(paths) if paths is not None else None
    if not text:
        text = page.text_at(page.best()[0])
    return text or ""


def host_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Pass 1: the paths of each host (host, paths, votes of the best, pages that voted): the one with the most votes, and
    those that more than half of its pages name. Pages without any text don't vote. A host's votes are counted on the
    map side first, so a host with a third of all pages costs a row a task and path."""
    prepare(pages.sparkSession)
    best = F.pandas_udf(_best, "paths array<string>, score double")
    voted = pages.select(host_of(col(url)).alias("host"), best(text_of(html)).alias("best")).where("best.score > 0")
    each = voted.select("host", F.explode(F.array_append("best.paths", F.lit(None).cast("string"))).alias("path"), "best.score")
    votes = each.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum(F.log1p("score")).alias("weight"))
    votes = keep_table(votes, "path_votes")  # a null path stands for the pages
    order = F.when(F.col("path").isNotNull(), F.struct("votes", F.round("weight", 3), "path"))
    hosts = votes.groupBy("host").agg(
        F.max_by("path", order).alias("first"), F.max(F.when(F.col("path").isNotNull(), F.col("votes"))).alias("votes"),
        F.max(F.when(F.col("path").isNull(), F.col("votes"))).alias("pages"),
    )
    named = votes.where("path IS NOT NULL").select("host", "path", F.col("votes").alias("own"))
    agreed = named.join(hosts.select("host", "pages"), "host").where(F.col("own") * 2 > F.col("pages"))
    agreed = agreed.groupBy("host").agg(F.collect_set("path").alias("paths"))  # less than two for each path that a page names
    paths = F.array_sort(F.array_union(F.array("first"), F.coalesce("paths", F.array().cast("array<string>"))))
    return hosts.join(agreed, "host", "left").select("host", paths.alias("paths"), "votes", "pages")


def extract(pages: DataFrame, url: str = "url", html: str = "html", broadcast_rows: int = 200_000,
            hot_share: int = 10_000) -> DataFrame:
    """All rows and columns of `pages` with a column main_text: the article, one line a block, empty if there is none.

    White space inside a block is one space, character references are decoded, nothing is cut. Null pages count as
    empty; pages without a host form a host of their own; repeated rows are extracted each; an empty table gives no rows. A
    column main_text of the pages gives way; other columns stay. A very long page is parsed in one go, in time and memory
    that follow its length. The winning paths are broadcast when they are at most `broadcast_rows` after counting. Beyond
    that, those of hosts with more than one page in `hot_share` are broadcast (there are less than `hot_share` of them), and
    the pages of all others meet theirs by host.
    """
    winners = keep_table(host_paths(pages, url, html), "host_paths")
    host, path, own = (free_name(pages, n) for n in ("page_host", "page_paths", "page_own_paths"))
    placed = pages.withColumn(host, host_of(col(url)))

    def named(some: DataFrame, paths: str) -> DataFrame:
        return some.select(F.col("host").alias(host), F.col("paths").alias(paths))

    if is_small(winners.select("host", F.array_join("paths", " ").alias("paths")), broadcast_rows):
        joined = placed.join(F.broadcast(named(winners, path)), host, "left")
    else:
        least = (winners.agg(F.sum("pages")).first()[0] or 0) / hot_share
        hot = named(winners.where(F.col("pages") > least), own)
        met = placed.join(F.broadcast(hot), host, "left")
        # a page that has its paths needs no partner: it goes anywhere
        met = met.withColumn(host, F.when(F.col(own).isNull(), F.col(host)).otherwise(F.concat(F.lit("<"), F.xxhash64(col(url), col(html)))))
        joined = met.join(named(winners.where(F.col("pages") <= least), path), host, "left")
        joined = joined.withColumn(path, F.coalesce(path, own))
    return joined.withColumn("main_text", F.pandas_udf(_extract, "string")(text_of(html), col(path))).select(
        *[col(c) for c in pages.columns if c.lower() != "main_text"], "main_text"
    )
