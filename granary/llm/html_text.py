"""Main text of web pages by consensus host paths.

Every page's containers are scored by their share of the page's prose. The scores are votes for the containers'
generalised paths (tags and classes from the body down, digits masked), added up per host in Spark. Pages
are then read again, and the text is taken from the containers on the host's winning path; a page that
hasn't got it uses its own main container, the innermost one with most of the prose.

A path is known by a hash chained from the parent's, and the blocks of an element are a range of the page's, so that
time and memory follow the page's length however deep its elements lie in each other.
"""

from __future__ import annotations

import html as entities
import re

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import sent, spread

# HTML's element kinds, and words by which boilerplate is often named.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that hold text only, no markup, and elements whose content is no text of the page.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
MUTED = frozenset("noscript template svg math object canvas audio video select optgroup option datalist button".split())
BLOCK = frozenset(
    "html head body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr caption ul".split()
)
CONTAINER = frozenset("body main article section div td blockquote center".split())
#: A start tag closes these elements if one of them is innermost.
CLOSES = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
CLOSES |= {"option": {"option"}, "optgroup": {"option", "optgroup"}} | dict.fromkeys(MUTED - {"option", "optgroup"}, set())
HARD = frozenset("head nav aside footer menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar".split())
USUAL = frozenset(
    "ad ads adsense advert adverts advertisement advertising advertorial billboard breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disqus "
    "footer gdpr leaderboard masthead menu menus modal nav navbar navigation newsletter notice notices overlay pager pagination popup popover promo promotion recommended "
    "related sharebar sharing sidebar sidenav signup sponsor sponsored subscribe subscription".split()
)
SOMETIMES = frozenset(
    "banner bottombar byline copyright disclaimer discussion feedback foot form header hidden legal login notification register replies reply respond responses search "
    "share sideblock skip social tags teaser toc toolbar topbar tracking widget widgets".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Evidence against an element that its name makes doubtful; from 1 it holds no main text, so a name alone never suffices. Beside it counts
#: that it stands outside the article, is a list of elements of one kind, is full of links, has no prose, is one short block, or part of the host's template.
NAMED_USUAL, NAMED_SOMETIMES, OUTSIDE, ALIKE, LINKED, NO_PROSE, BRIEF, TEMPLATE = 0.8, 0.5, 0.2, 0.2, 0.3, 0.3, 0.2, 0.5
#: Share of the page's text up to which one block is short.
SHORT = 0.05
#: Words, or characters, of a block that reads as prose.
PROSE_WORDS, PROSE_CHARS = 10, 60
#: The main container is the innermost one with so much of the page's prose; a single article beside the rest needs less.
SHARE, ARTICLE_SHARE = 0.75, 0.4
#: Share of a thread's text that its posts hold.
POSTS = 0.8
#: Pages of a host, at least, on which an element's text is the same if it is part of the template.
TEMPLATE_PAGES = 3
_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?![^\s=])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_QUOTED = re.compile(r"\"[^\"]*+\"|'[^']*+'")
_UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
_WORDS = re.compile(r"[a-z]+")
_DIGITS = re.compile(r"\d+")
#: The rest of a tag: quoted values may hold a ">". No part is ever tried twice.
_TAG_REST = re.compile(r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>""")


def _attributes(text: str) -> dict[str, str]:
    """The attributes that matter here, values in lower case."""
    return {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(text)} if text else {}


def _is_hidden(text: str) -> bool:
    """Whether an element's attributes say that it isn't shown."""
    lowered = text.lower()
    if "hidden" not in lowered and "none" not in lowered:
        return False
    found = _attributes(text)
    bare = "hidden" in found and re.search(r"(?:^|\s)hidden(?![^\s=])", _QUOTED.sub("", lowered)) is not None
    return bare or found.get("aria-hidden") == "true" or _UNSEEN.search(found.get("style", "")) is not None


class Page:
    """A page's elements and blocks. Inline elements leave no trace but white space where they break lines, unless they are hidden."""

    def __init__(self, source: str):
        self.tags, self.parents, self.labels, self.evidence = ["html"], [-1], [""], [0.0]
        self.keys, self.begins, self.ends = [0], [0], [0]
        self.blocks: list[tuple[int, str, int, int]] = []
        self._stack, self._open, self._muted, self._text, self._links, self._n_links, self._in_link = [0], {"html": 1}, 0, [], 0, 0, 0
        self._endless: set[str] = set()
        self._read(source)
        self._flush()
        self._pop(0)
        self._measure()

    def _flush(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.blocks.append((self._stack[self._muted - 1 if self._muted else -1], text, self._links, self._n_links))
            self._text, self._links, self._n_links = [], 0, 0

    def _add(self, raw: str) -> None:
        if self._muted:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        self._text.append(text)
        if self._in_link:
            self._links += len(text.strip())

    def _read(self, source: str) -> None:
        at, n = 0, len(source)
        while at < n:
            tag = source.find("<", at)
            if tag < 0:
                self._add(source[at:])
                return
            if tag > at:
                self._add(source[at:tag])
            if source.startswith("<!--", tag):
                end = source.find("-->", tag + 4)
                at = n if end < 0 else end + 3
                continue
            found = _NAME.match(source, tag + 1)
            if not found:
                if source[tag + 1 : tag + 2] in ("!", "?", "/"):
                    end = source.find(">", tag)
                    at = n if end < 0 else end + 1
                else:
                    self._add("<")
                    at = tag + 1
                continue
            rest = _TAG_REST.match(source, found.end())
            end = rest.end() - 1 if rest else source.find(">", found.end())  # a quote that is never closed ends nothing
            if end < 0:
                return  # the page ends inside a tag
            name, at = found[1].lower(), end + 1
            if source[tag + 1] == "/":
                self._end(name)
            else:
                closed = source[end - 1] == "/"
                self._start(name, source[found.end() : end], closed)
                if name in RAW and not closed:
                    at = self._raw_end(source, name, at)

    def _raw_end(self, source: str, name: str, at: int) -> int:
        """Where reading goes on after an element that holds text only; without an end tag it ends where an open element does."""
        closing = None if name in self._endless else re.compile(f"</{re.escape(name)}(?![a-z0-9])", re.I).search(source, at)
        if closing:
            end = source.find(">", closing.end())
            return len(source) if end < 0 else end + 1
        self._endless.add(name)  # nor is there one further on
        outer = re.compile(f"</(?:{'|'.join(re.escape(x) for x, many in self._open.items() if many)})(?![a-z0-9])", re.I).search(source, at)
        return outer.start() if outer else len(source)

    def _start(self, name: str, attributes: str, closed: bool) -> None:
        if name == "a":
            self._in_link = 1
            self._n_links += not self._muted
        if name == "br" and not self._muted:
            self._text.append(" ")
        block = name in BLOCK
        hidden = not closed and name not in VOID and (_is_hidden(attributes) if attributes else False)
        # a muted element's own kind is followed inside it, so that its end tag is told from theirs
        inner = self._muted and name == self.tags[self._stack[self._muted]] and not closed
        if not block and not hidden and not inner and (name not in MUTED or closed):
            return
        if block and not self._muted:
            self._flush()
        if name in ("hr", "html"):
            return
        if block or name in MUTED:
            closes = CLOSES.get(name, ("p",))
            while len(self._stack) > 1 and self.tags[self._stack[-1]] in closes:
                self._pop(len(self._stack) - 1)
        if name == "body" and self._open.get("body"):
            return
        found = _attributes(attributes)
        words = {*_WORDS.findall(f"{found.get('class', '')} {found.get('id', '')}")}
        classes = sorted({_DIGITS.sub("#", x) for x in found.get("class", "").split()})
        named = 0.0 if name in HEADINGS else NAMED_USUAL if words & USUAL else NAMED_SOMETIMES if words & SOMETIMES else 0.0
        up = self._stack[-1]
        self.tags.append(name)
        self.parents.append(up)
        self.labels.append(".".join([name, *classes]))
        self.keys.append(xxhash.xxh3_64_intdigest(self.labels[-1], self.keys[up]) if name != "html" else self.keys[up])
        self.evidence.append(1.0 if found.get("role") in ROLES else named)
        self.begins.append(len(self.blocks))
        self.ends.append(len(self.blocks))
        self._stack.append(len(self.tags) - 1)
        self._open[name] = self._open.get(name, 0) + 1
        if (name in MUTED or hidden) and not self._muted:
            self._muted = len(self._stack) - 1

    def _pop(self, depth: int) -> None:
        for node in self._stack[depth:]:
            self.ends[node] = len(self.blocks)
            self._open[self.tags[node]] -= 1
        del self._stack[depth:]
        if self._muted >= depth:
            self._muted = 0

    def _end(self, name: str) -> None:
        if name == "a":
            self._in_link = 0
        block = name in BLOCK
        if self._open.get(name) and name != "html":
            depth = next(d for d in range(len(self._stack) - 1, 0, -1) if self.tags[self._stack[d]] == name)
            if block and (not self._muted or depth < self._muted):
                self._flush()
            self._pop(depth)
        elif block and not self._muted:
            self._flush()

    def _measure(self) -> None:
        """Sums over the elements, and which of them hold no main text, as far as the page itself tells."""
        n = len(self.tags)
        self.size, self._links_of, self._links_in, items = [0] * n, [0] * n, [0] * n, [0] * n
        self._proses, prose_size, self._headed = [0] * n, [0] * n, [False] * n
        self._is_prose = [len(text) - 2 * linked >= PROSE_CHARS or linked == 0 and text.count(" ") >= PROSE_WORDS - 1 for _, text, linked, _ in self.blocks]
        for (node, text, linked, many), prose in zip(self.blocks, self._is_prose):
            self.size[node] += len(text)
            self._links_of[node] += linked
            self._links_in[node] += many
            self._proses[node] += prose
            prose_size[node] += prose * len(text)
        for k in range(n - 1, 0, -1):
            up = self.parents[k]
            self.size[up] += self.size[k]
            self._links_of[up] += self._links_of[k]
            self._links_in[up] += self._links_in[k]
            self._proses[up] += self._proses[k]
            prose_size[up] += prose_size[k]
            items[up] += self.tags[k] == "li"
            self._headed[up] |= self._headed[k] or self.tags[k] in HEADINGS
        self._find_roots()
        alike = self._find_threads()
        whole, prose = self.size[0], prose_size[0]
        for k in range(1, n):
            tag, size, named = self.tags[k], self.size[k], self.evidence[k]
            listing = tag in ("ul", "ol") and items[k] >= 3 or tag in ("div", "section", "table", "center") and self._links_in[k] >= 3
            # a form is none of the article unless the page is written in one; a header is the page's unless it stands in the article or in a part of the page
            form = tag == "form" and 2 * prose_size[k] <= prose
            header = tag == "header" and not self._inside[k] and (10 * self.size[self.parents[k]] >= 9 * whole or self._links_of[k] >= 0.3 * size)
            if tag in HARD or form or header or listing and self._links_of[k] >= 0.9 * size > 0 or k in self._threads:
                self.evidence[k] = 1.0
            elif 0 < named < 1:
                beside = len(self._roots) > 0 and not self._marked[k] and not self._inside[k]
                brief = self._proses[k] <= 1 and size <= SHORT * whole
                self.evidence[k] += OUTSIDE * beside + ALIKE * alike[k] + LINKED * (self._links_of[k] >= 0.3 * size) + NO_PROSE * (not self._proses[k]) + BRIEF * brief
        self.judge(frozenset())

    def _find_roots(self) -> None:
        """The elements that are marked as the article, and without any the title's container, with what lies around and inside them."""
        n = len(self.tags)
        roots = {k for k in range(1, n) if self.tags[k] in ("article", "main") and not self.evidence[k] and self.size[k]}
        alike: dict[tuple[int, str], int] = {}
        for k in roots:
            alike[self.parents[k], self.labels[k]] = alike.get((self.parents[k], self.labels[k]), 0) + 1
        # several of one kind without headings, beside another, are posts
        roots = {k for k in roots if self._headed[k] or alike[self.parents[k], self.labels[k]] < 2} or roots
        self._title = next((k for k in range(1, n) if self.tags[k] == "h1" and self.size[k]), 0)
        if not roots and self._title:
            for enough in (lambda k: self._proses[k], lambda k: self.ends[k] - self.begins[k] >= 3 and self.tags[k] != "header"):
                k = self.parents[self._title]
                while k > 0 and not enough(k):
                    k = self.parents[k]
                if k > 0 and self.tags[k] != "body":
                    roots = {k}
                    break
        self._roots, self._inside, self._marked = roots, [False] * n, [False] * n
        for k in range(1, n):
            self._inside[k] = k in roots or self._inside[self.parents[k]]
        for k in range(n - 1, 0, -1):
            self._marked[self.parents[k]] |= self._marked[k] or k in roots or k == self._title

    def _find_threads(self) -> list[bool]:
        """Sets the elements that hold posts of readers, whatever they are called; returns which elements have several children of one kind.

        Posts are siblings of one tag and class without headings, and hold most of their parent's text. A thread follows
        prose of another make, the article's, and after it no prose comes but what lies in other such elements.
        """
        n = len(self.tags)
        groups: list[dict[str, list[int]] | None] = [None] * n
        for k in range(1, n):
            if self.tags[k] in ("div", "article", "section", "li") and self.size[k] and not self._marked[k]:
                up = self.parents[k]
                if groups[up] is None:
                    groups[up] = {}
                groups[up].setdefault(self.labels[k], []).append(k)
        kinds = [max(map(len, g.values())) if g else 0 for g in groups]
        before = [0]
        for prose in self._is_prose:
            before.append(before[-1] + prose)
        in_root = [0]
        for (node, *_), prose in zip(self.blocks, self._is_prose):
            in_root.append(in_root[-1] + (prose and self._inside[node]))
        apart = [False] * n  # by tag or role, or doubtful by name
        for k in range(1, n):
            apart[k] = apart[self.parents[k]] or self.tags[k] in HARD or self.tags[k] == "form" or self.evidence[k] > 0
        plain = [0]
        for (node, *_), prose in zip(self.blocks, self._is_prose):
            plain.append(plain[-1] + (prose and not apart[node]))
        covered = len(self.blocks)  # where the threads begin that were found so far
        self._threads: set[int] = set()
        for k in range(n - 1, 0, -1):  # from the page's end on; inner elements before what holds them
            found = groups[k]
            if not found or self.tags[k] in ("body", "main") or self.tags[k] == "article" and k in self._roots or self._marked[k]:
                continue
            label, posts = max(found.items(), key=lambda x: sum(self.size[p] for p in x[1]))
            told = "." in label and not any(self._headed[p] for p in posts) and any(self._proses[p] for p in posts)
            told &= self.tags[posts[0]] != "li" or all(self.ends[p] - self.begins[p] >= 2 for p in posts)  # a list's items are posts if they say who wrote them
            if len(posts) < 2 or not told or sum(self.size[p] for p in posts) < POSTS * self.size[k]:
                continue
            first, last = self.begins[k], self.ends[k]
            ahead = before[first] >= 2 or in_root[first] >= 1
            if ahead and plain[covered] <= plain[min(last, covered)]:
                self._threads.add(k)
                covered = min(covered, first)
        return [x >= 2 for x in kinds]

    def judge(self, templates: frozenset) -> None:
        """Marks the elements without main text; templates are keys of paths whose text is the same on the host's pages."""
        self.out = [False] * len(self.tags)
        for k in range(1, len(self.tags)):
            weight = self.evidence[k]
            if 0 < weight < 1 and self.keys[k] in templates:
                weight += TEMPLATE
            # a wrapper of the article with most of the page's text is no boilerplate, whatever it is called
            wraps = self.tags[k] not in HARD and self._marked[k] and 2 * self.size[k] > self.size[0]
            self.out[k] = self.out[self.parents[k]] or weight > 0.99 and not wraps and self.tags[k] != "body"

    def path(self, node: int) -> str:
        labels = []
        while node > 0:
            if self.tags[node] != "html":
                labels.append(self.labels[node])
            node = self.parents[node]
        return ">".join(reversed(labels))

    def scores(self) -> dict[int, float]:
        """The containers' shares of the page's prose: lengths of blocks, less twice their links."""
        worth = [0] * len(self.tags)
        for node, text, linked, _ in self.blocks:
            if not self.out[node]:
                worth[node] += max(len(text) - 2 * linked, 0)
        for k in range(len(worth) - 1, 0, -1):
            worth[self.parents[k]] += worth[k]
        total = worth[0]
        return {k: worth[k] / total for k in range(len(worth)) if worth[k] and not self.out[k] and (k == 0 or self.tags[k] in CONTAINER)} if total else {}

    def main(self, shares: dict[int, float]) -> int:
        """The innermost container with most of the prose, and with the title; inside an article element, that whole element."""
        best = max(k for k, share in shares.items() if share >= SHARE)  # such containers lie inside each other, the innermost has the largest number
        title = self._title if self._title and not self.out[self._title] else 0
        around = {title}
        while title > 0:
            title = self.parents[title]
            around.add(title)
        node = best
        while node > 0:
            if self.tags[node] == "article" or best not in around and len(around) > 1 and node in shares and node in around:
                best = node
            node = self.parents[node]
        best = best if best in around or len(around) == 1 else 0
        # one article and no other stands beside things that are no part of it
        outer: list[int] = []
        for k in sorted(self._roots):
            within = k > best and self.begins[best] <= self.begins[k] < self.ends[best] and self.tags[k] in ("article", "main")
            if within and shares.get(k, 0) >= ARTICLE_SHARE and not (outer and self.begins[k] < self.ends[outer[-1]]):
                outer.append(k)
        return outer[0] if len(outer) == 1 and (len(around) == 1 or outer[0] in around) else best

    def votes(self) -> dict[int, float]:
        """One for the key of the main container's path; for others' paths less than half, by their shares."""
        shares = self.scores()
        out: dict[int, float] = {}
        for k, share in shares.items():
            out[self.keys[k]] = max(out.get(self.keys[k], 0.0), 0.4 * share)
        if shares:
            out[self.keys[self.main(shares)]] = 1.0
        return out

    def doubtful(self) -> dict[int, int]:
        """Key of the path and hash of the text of the elements that their name makes doubtful but not more; of equal paths all texts count."""
        some = [k for k, weight in enumerate(self.evidence) if 0 < weight < 1 and self.begins[k] < self.ends[k]]
        if not some:
            return {}
        # prefix sums of a rolling hash: any range of blocks is one subtraction
        prime, base, total, powers = (1 << 61) - 1, 0x1E3779B97F4A7C15 % ((1 << 61) - 1), [0], [1]
        for _, text, *_ in self.blocks:
            total.append((total[-1] * base + xxhash.xxh3_64_intdigest(text)) % prime)
            powers.append(powers[-1] * base % prime)
        out: dict[int, int] = {}
        for k in some:
            first, last = self.begins[k], self.ends[k]
            own = (total[last] - total[first] * powers[last - first]) % prime
            out[self.keys[k]] = (out.get(self.keys[k], 0) * base + own) % prime
        return out

    def text(self, key: int | None, templates: frozenset = frozenset()) -> tuple[str, str]:
        """The blocks under the path of that key (if the page hasn't got it, under its own main container) and that path."""
        if templates:
            self.judge(templates)
        shares = self.scores()
        if not shares:
            return "", ""
        chosen = {k for k in shares if self.keys[k] == key} if key is not None else set()
        if not chosen:
            chosen = {self.main(shares)}
        inside = [False] * len(self.tags)
        for k in range(len(self.tags)):
            inside[k] = k in chosen or k > 0 and inside[self.parents[k]]
        found = "\n".join(text for node, text, *_ in self.blocks if inside[node] and not self.out[node])
        return found, self.path(min(chosen))


def host_of(url):
    """The lower-cased host of a url column; empty where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.regexp_replace(host, r"^www\.", "")


def host_paths(pages: DataFrame) -> DataFrame:
    """voted_host, voted_path (the key of the path with the most votes of every host, of equal ones the least) and templates. pages: host, html.

    templates are the keys of paths of doubtful elements whose text is the same on all pages of the host that have them, TEMPLATE_PAGES at least.
    """
    import pyarrow as pa

    signed = lambda key: key - (1 << 64) if key >= 1 << 63 else key

    def run(batches):
        for batch in batches:
            rows = []
            for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page = Page(source or "")
                rows += [(host, signed(key), round(score * 1000), None) for key, score in page.votes().items()]
                rows += [(host, signed(key), 0, own) for key, own in page.doubtful().items()]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["host", "path", "score", "same"])

    found = pages.select("host", "html").mapInArrow(run, "host string, path long, score long, same long")
    votes = found.groupBy("host", "path").agg(F.sum("score").alias("score"), F.count("same").alias("n"), F.min("same").alias("low"), F.max("same").alias("high"))
    first = F.min(F.when(F.col("score") > 0, F.struct((-F.col("score")).alias("less"), "path")))
    constant = (F.col("n") >= TEMPLATE_PAGES) & (F.col("low") == F.col("high"))
    hosts = votes.groupBy(F.col("host").alias("voted_host")).agg(first.alias("best"), F.array_sort(F.collect_list(F.when(constant, F.col("path")))).alias("templates"))
    return hosts.select("voted_host", F.col("best.path").alias("voted_path"), "templates")


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars, host, path.

    text holds the blocks of the main container in page order, joined by line breaks; white space inside a
    block is one space. Menus, footers, sidebars, the page's header and forms (but for one that the page is written in) are left out by
    element or role, scripts, styles, markup, lists of links and what isn't shown always. An element's name (adverts, notices, reader comments) counts as
    evidence, and needs more: that it lies outside the article, is a list of alike elements, is full of links, has no prose, is one short block, or has
    the same text on the host's pages. Readers' posts are also known by their make alone, see Page._find_threads.
    Null or empty html gives an empty text. Pages without a host vote together. Repeated rows give equal rows; an empty table gives none.

    Votes are combined before their shuffle, so a host with a third of all pages is no hot spot. The winning
    paths, one line per host, are sent to the pages as long as hosts are few enough for that; beyond it pages
    meet them in a left join, in which the adaptive skew join splits large hosts.
    """
    import pyarrow as pa

    picked = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    picked = spread(picked)
    voted = sent(host_paths(picked))
    rows = picked.join(voted, picked["host"] == voted["voted_host"], "left").select("page_id", "url", "host", "voted_path", "templates", "html")

    def run(batches):
        for batch in batches:
            paths, templates, sources = (batch.column(k).to_pylist() for k in (3, 4, 5))
            unsigned = lambda key: None if key is None else key & (1 << 64) - 1
            found = [Page(source or "").text(unsigned(path), frozenset(map(unsigned, known or ()))) for path, known, source in zip(paths, templates, sources)]
            texts, paths = ([x[k] for x in found] for k in (0, 1))
            sizes = pa.array([len(x) for x in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes, batch.column(2), pa.array(paths, pa.string())], ["page_id", "url", "text", "n_chars", "host", "path"]
            )

    kinds = dict(picked.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url string, text string, n_chars long, host string, path string")
