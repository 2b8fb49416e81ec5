"""Main text of web pages by consensus of their host.

Each page is cut into containers (division, section, article and the like) and text blocks; the container that
holds its main text is scored by the page alone.  Its generalised path, the tags and classes from the root with
numbers taken out, is the page's vote.  Spark counts the votes of every host; the paths with a fair share of them win,
and each page is extracted again from the containers on the first winning path that it has.  A page that has none, or
no host, is extracted from its own best container.

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments go wherever they stand, known by
tag, by a word of their class, id or role, or, outside articles and the chosen container, by being made of links.  A word
does not drop what holds most of the page's text with its title, nor the container on a winning path that holds more
than all that is left; inside articles only whole classes count, as its sections may be called anything.

Defined cases: null or empty pages, and pages without text, give the empty text; tags that are never closed end with
the page, stray closing tags are passed over; text outside all tags counts as the root's; a null url has no host;
repeated rows are each returned; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialise

LEAST_SHARE = 0.05  # of a host's votes; at most twenty paths have it
MOST = 0.5  # of a page's text that its article holds
DESCEND = 0.6  # of a container's text that its child must hold to be taken instead
LINKS = 0.6  # of a container's text that stands in links of a menu

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|noscript|textarea|title|iframe)"
    r"\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>(?:.*?</(?P=raw)\s*+>|.*\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>",
    re.DOTALL | re.IGNORECASE,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")
_ZEROS, _LARGE = re.compile(r"&#0+(?=[0-9])"), re.compile(r"&#[0-9]{8,}")
_NUMBER = re.compile(r"[0-9]+")

CONTAINERS = frozenset(
    "html body div section article main aside nav header footer form table td ul ol dl menu figure details dialog "
    "center fieldset blockquote".split()
)
BLOCKS = CONTAINERS | frozenset(
    "address br dd dt figcaption h1 h2 h3 h4 h5 h6 head hgroup hr legend li optgroup option p pre summary tbody "
    "tfoot th thead tr".split()
)
ASIDE_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising "
    "sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal overlay "
    "comment comments discussion replies disqus respond share sharing social related recommended breadcrumb "
    "breadcrumbs pagination pager widget newsletter subscribe signup login form search toolbar copyright".split()
)
ARTICLE_ASIDE_WORDS = frozenset("comment comments ad ads advert promo sponsored related teaser".split())
#: Whole classes of what is no part of the article that it stands in, and ids.
INSIDE_CLASSES = frozenset(
    "nav navbar navigation menu sidebar ad ads advert adverts advertisement advertising sponsor sponsored promo cookie "
    "cookies consent gdpr popup modal overlay comment comments disqus replies respond share sharing social related "
    "breadcrumb breadcrumbs pagination pager widget newsletter subscribe signup login toolbar footer masthead "
    "related-posts related-articles share-buttons social-share social-links post-comments comments-area comment-list "
    "ad-container ad-slot newsletter-signup post-navigation nav-links post-footer entry-footer cookie-notice "
    "cookie-banner".split()
)
INSIDE_IDS = frozenset("comments disqus_thread respond sidebar".split())
#: Parts of a class or id that name an aside inside articles too, where it holds less than nearly all of the article, and no title.
STRONG_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr sidebar comment "
    "comments disqus newsletter breadcrumb breadcrumbs pagination popup modal".split()
)
NOTICES = frozenset("site-notice privacy-notice legal-notice".split())
ROLES = frozenset("navigation complementary banner contentinfo search dialog alertdialog".split())
#: Elements whose text is no text of the page, up to their end; without one, up to the next block.
SILENT = frozenset("template select svg object canvas video audio button".split())
#: Whole classes of blocks and of marked words that are asides.
SMALL_CLASSES = frozenset("ad ads advert advert-label advertisement sponsored promo".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER_ASIDE = frozenset(["html", "body", "main"])
WIDE = frozenset(["root", "html", "body"])  # hold menus too, even when chosen
UNTITLED = 0.9  # of the text that a container with an aside's name holds where no title tells what the page is about
HEADINGS = frozenset(["h1", "h2"])


def decoded(text: str) -> str:
    """With character references read; numbers of any length, beyond the last code point as U+FFFD."""
    if "&#" in text:
        text = _LARGE.sub("&#1114112", _ZEROS.sub("&#", text))
    return entities.unescape(text)


def _attributes(attrs: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if attrs.strip() else {}


def _hidden(named: dict[str, str], attrs: str) -> bool:
    style = named.get("style", "").replace(" ", "").lower()
    return bool(
        "display:none" in style or named.get("aria-hidden") == "true" or re.search(r"(?:^|\s)hidden(?:\s|=|$)", attrs)
    )


def _open_ended(match: re.Match) -> bool:
    """Whether a comment or an element of raw text has no end."""
    if match["raw"]:
        return not re.search(rf"</{match['raw']}\s*>\Z", match[0], re.IGNORECASE)
    return match[0].startswith("<!--") and not match[0].endswith("-->")


class Page:
    """Containers and text blocks of a page, in page order; container 0 is the root."""

    def __init__(self, source: str):
        self.parent, self.path, self.tag = [-1], [0], ["root"]
        self.hard, self.word, self.inner = [False], [False], [False]  # asides by tag or style, by a word, in an article
        self.written = ["root"]  # tags as they are closed; ``tag`` follows the role
        self.blocks: list[tuple[int, str]] = []  # container, text
        self.headed = [False]  # a heading stands right in the container
        self.titles = [0]  # first-rank headings, articles and main parts in the container
        self.own, self.linked = [0], [0]  # code points of text right in the container, and in links
        self._cut(source)
        self._sum()

    def _open(self, at: int, tag: str, attrs: str) -> int:
        import xxhash

        named = _attributes(attrs)
        classes = sorted({_NUMBER.sub("#", c) for c in named.get("class", "").lower().split()})
        step = f"{self.path[at]}/{tag}.{'.'.join(classes)}"
        self.parent.append(at)
        self.path.append(xxhash.xxh64_intdigest(step.encode("utf-8", "replace")) >> 1)
        self.written.append(tag)
        self.tag.append("main" if named.get("role", "").lower() == "main" else tag)
        self.hard.append(self.hard[at] or self._is_hard(tag, named, attrs))
        self.word.append(self._is_word(tag, named))
        self.inner.append(self._is_inner(tag, named))
        self.headed.append(False)
        self.titles.append(int(self.tag[-1] in ("article", "main") and not self.word[-1]))
        self.own.append(0)
        self.linked.append(0)
        return len(self.parent) - 1

    @staticmethod
    def _is_hard(tag: str, named: dict[str, str], attrs: str) -> bool:
        if tag in NEVER_ASIDE:
            return False
        if tag in ASIDE_TAGS:
            return True
        if not named and "hidden" not in attrs:
            return False
        return named.get("role", "").lower() in ROLES or _hidden(named, attrs)

    @staticmethod
    def _is_word(tag: str, named: dict[str, str]) -> bool:
        if tag in NEVER_ASIDE or named.get("role", "").lower() == "main":
            return False
        for name in ("class", "id", "role"):
            for token in named.get(name, "").split():
                words = {w.lower() for w in _CAMEL.split(token) if w}
                found = words & (ARTICLE_ASIDE_WORDS if tag == "article" else ASIDE_WORDS)
                if found == {"header"} and words & {"article", "entry", "post"}:
                    continue  # the article's own heading
                if found:
                    return True
        return False

    @staticmethod
    def _is_inner(tag: str, named: dict[str, str]) -> bool:
        tokens = [*named.get("class", "").lower().split(), *named.get("id", "").lower().split()]
        if not INSIDE_CLASSES.isdisjoint(named.get("class", "").lower().split()) or not NOTICES.isdisjoint(tokens):
            return True
        if named.get("id", "").lower() in INSIDE_IDS:
            return True
        return any(not STRONG_WORDS.isdisjoint(_CAMEL.split(token)) for token in tokens)

    @staticmethod
    def _is_silent(tag: str, attrs: str) -> bool:
        """Whether the text of an element that is no container is left out."""
        if tag in SILENT:
            return True
        if not attrs.strip() or tag in VOID:
            return False
        named = _attributes(attrs)
        classes = named.get("class", "").lower().split()
        if not SMALL_CLASSES.isdisjoint(classes) or (tag in ("li", "p", "dd") and "comment" in classes):
            return True
        return _hidden(named, attrs)

    @staticmethod
    def _ends(matches: list[re.Match]) -> dict[int, int]:
        """For every opening tag that is closed, by the places of both among the tags."""
        open_: dict[str, list[int]] = {}
        ends = {}
        for i, match in enumerate(matches):
            tag = match["tag"] or match["tag2"]
            if tag:
                tag = tag.lower()
                if not (match["close"] or match["close2"]):
                    open_.setdefault(tag, []).append(i)
                elif open_.get(tag):
                    ends[open_[tag].pop()] = i
        return ends

    def _cut(self, source: str) -> None:
        stack, at, links = [0], 0, 0
        open_: dict[str, int] = {}
        parts: list[str] = []
        in_links, heading, title, here = 0, False, False, 0
        silent: list[tuple[int, int]] = []  # containers open round each silent element, and its last tag
        unclosed = False  # in a silent element without an end

        def flush() -> None:
            nonlocal in_links
            if parts:
                text = " ".join(decoded("".join(parts)).split())
                parts.clear()
                if text:
                    where = stack[-1]
                    self.blocks.append((where, text))
                    self.own[where] += len(text)
                    self.linked[where] += min(in_links, len(text))
                    self.headed[where] |= heading
                    self.titles[where] += title
            in_links = 0

        last = source.rfind(">") + 1  # no tag ends after it
        matches = list(_TAG.finditer(source, 0, last))
        ends = self._ends(matches)
        for place, match in enumerate(matches):
            if match.start() > here and not silent and not unclosed:
                piece = source[here : match.start()]
                parts.append(piece)
                if links:
                    in_links += len(piece)
            here = match.end()
            if here == last and _open_ended(match):
                here = len(source)
            tag = match["tag"] or match["tag2"]
            if not tag:
                continue
            tag = tag.lower()
            closing = bool(match["close"] or match["close2"])
            attrs = match["attrs"] or match["attrs2"] or ""
            while silent and place >= silent[-1][1]:
                silent.pop()
            if tag in BLOCKS:
                unclosed = False
            if not closing and tag not in CONTAINERS and self._is_silent(tag, attrs) and not attrs.endswith("/"):
                if place in ends:
                    silent.append((len(stack), ends[place]))
                else:
                    unclosed = True
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
                continue
            if tag not in BLOCKS:
                continue
            flush()
            links = 0 if tag in CONTAINERS else links
            heading = tag in HEADINGS and not closing
            title = tag == "h1" and not closing
            if tag not in CONTAINERS:
                continue
            if not closing:
                if (tag in ("html", "body") and open_.get(tag)) or (match["attrs"] or "").endswith("/"):
                    continue
                at = self._open(stack[-1], tag, attrs)
                stack.append(at)
                open_[tag] = open_.get(tag, 0) + 1
            elif open_.get(tag):
                while True:
                    gone = stack.pop()
                    name = self.written[gone]
                    open_[name] -= 1
                    if name == tag:
                        break
                while silent and silent[-1][0] > len(stack):
                    silent.pop()
        if here < len(source) and not silent and not unclosed:
            parts.append(source[here:])
        flush()

    def _sum(self) -> None:
        """Text in each container and what it holds, without asides."""
        whole, linked, open_ = list(self.own), list(self.linked), list(self.own)
        titles = list(self.titles)
        for i in range(len(self.parent) - 1, 0, -1):
            at = self.parent[i]
            whole[at] += whole[i]
            linked[at] += linked[i]
            if self.hard[i]:
                open_[i] = titles[i] = 0
            open_[at] += open_[i]
            titles[at] += titles[i]
        #: Text without that of asides by tag or style, whatever their names.
        self.open = open_
        self.titled = [n > 0 for n in titles]
        self.menu = [False] * len(self.parent)
        self.spared = [False] * len(self.parent)
        for i in range(1, len(self.parent)):
            self.menu[i] = self.tag[i] not in NEVER_ASIDE and whole[i] > 0 and linked[i] >= LINKS * whole[i]
            least = MOST if titles[i] else 1.0 if titles[0] else UNTITLED
            self.spared[i] = open_[i] > 0 and open_[i] >= least * open_[0]
        self.aside = self._asides(set())
        self.text = [0 if aside else n for aside, n in zip(self.aside, self.own, strict=True)]
        for i in range(len(self.parent) - 1, 0, -1):
            self.text[self.parent[i]] += self.text[i]

    def _asides(self, roots: set[int]) -> list[bool]:
        """Whether each container is, or stands in, an aside when the page is extracted from ``roots``."""
        above = set()
        for i in roots:
            while i > 0 and i not in above:
                above.add(i)
                i = self.parent[i]
        out, article, chosen = [False], [0], [False]  # article: the outermost one round a container, or 0
        for i in range(1, len(self.parent)):
            at = self.parent[i]
            article.append(article[at] or (i if self.tag[i] == "article" else 0))
            chosen.append(chosen[at] or (i in roots and self.tag[i] not in WIDE))
            if article[at] and self.tag[i] != "article":
                whole = self.titled[i] or self.open[i] >= UNTITLED * self.open[article[at]]
                named = self.inner[i] and not whole
            else:
                named = self.word[i] and not self.spared[i]
            menu = self.menu[i] and not article[i] and not chosen[i]
            out.append(out[at] or self.hard[i] or (i not in above and (named or menu)))
        return out

    def best(self) -> int:
        """The container that the page alone would be extracted from."""
        if not self.text[0]:
            return 0
        for tag in ("article", "main"):
            found = [i for i, t in enumerate(self.tag) if t == tag and self.text[i] >= MOST * self.text[0]]
            if found:
                return max(found, key=lambda i: (self.text[i], -i))
        kids: dict[int, list[int]] = {}
        for i in range(1, len(self.parent)):
            if self.text[i]:
                kids.setdefault(self.parent[i], []).append(i)
        at = 0
        while at in kids:
            child = max(kids[at], key=lambda i: (self.text[i], -i))
            if self.text[child] < DESCEND * self.text[at]:
                break
            if self.headed[at] and self.text[at] - self.text[child] < 0.1 * self.text[at]:
                break  # what it adds is little more than the heading
            at = child
        return at

    def extract(self, roots: set[int]) -> str:
        """Text of the blocks in the given containers, without asides."""
        inside = [i in roots for i in range(len(self.parent))]
        for i in range(1, len(inside)):
            inside[i] |= inside[self.parent[i]]
        aside = self._asides(roots)
        return " ".join(text for where, text in self.blocks if inside[where] and not aside[where])

    def on_path(self, path: int) -> set[int]:
        here = [i for i, p in enumerate(self.path) if p == path]
        found = {i for i in here if self.text[i]}
        if found:
            return found
        # Asides by name alone that hold more than all that is left.
        return {i for i in here if not self.hard[i] and self.open[i] > self.text[0]}


def host() -> Column:
    """Host of ``url``, lower-cased, without user and port; null where there is none."""
    found = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(found, F.lit(""))


def votes(pages: DataFrame) -> DataFrame:
    """``host`` and ``path`` of every page with a host and text."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            paths = []
            for source in batch.column(1).to_pylist():
                page = Page(source or "")
                best = page.best()
                paths.append(page.path[best] if page.text[best] else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.int64())], ["host", "path"])

    rows = pages.select(host().alias("host"), "html").filter("host is not null and html is not null")
    return rows.mapInArrow(run, "host string, path bigint").filter("path is not null")


def winning_paths(pages: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """``host`` and ``paths``: those with at least ``least_share`` of its votes, most votes first."""
    counted = materialise(votes(pages).groupBy("host", "path").agg(F.count(F.lit(1)).alias("n")))
    totals = counted.groupBy("host").agg(F.sum("n").alias("total"))
    fair = counted.join(totals, "host").filter(F.col("n") >= least_share * F.col("total"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "path")))
    return fair.groupBy("host").agg(F.transform(ordered, lambda x: x["path"]).alias("paths"))


def extract_main(pages: DataFrame, least_share: float = LEAST_SHARE) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row."""
    winners = materialise(winning_paths(pages, least_share))
    winners = winners.select(F.col("host").alias("__host"), F.col("paths").alias("__paths"))
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for source, paths in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                page = Page(source or "")
                roots = next((found for path in paths or () if (found := page.on_path(path))), {page.best()})
                out.append(page.extract(roots))
            columns = [batch.column(0), batch.column(1), pa.array(out, pa.string())]
            columns.append(pa.array(list(map(len, out)), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", "html", host().alias("__key"))
    rows = rows.join(winners, F.col("__key") == F.col("__host"), "left").select("page_id", "url", "html", "__paths")
    return rows.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")
