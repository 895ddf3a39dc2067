"""Main text of web pages by composite text density.

A page is read into a tree of elements. Scripts, styles, controls and the like hold no text. What names itself as
something else than the article (menus, headers, footers, sidebars, notices, adverts, forms, reader comments, what is
hidden, by element, role, class or id) is cut off where its place or its density agrees with the name: outside the main
article always (the `article` or `main` with most text outside links, or else the core found without named blocks), and
inside it where links make up a third of the block or it has fewer characters per tag than half of the article's or,
for names in OTHER, fewer than the article. There, and in an article that no `article` or `main` bounds, a named block
before or after all other text goes too, and what is hidden always. A name borne by most of the article's
text tells nothing (a form round the whole page, widgets that hold the paragraphs), nor does one round the article.

Each remaining node has a composite density: characters per tag, lowered where many of the characters
and tags belong to links. A node's density sum is that of its children. The node with the largest sum is the core of
the article, widened to the `article` or `main` element round it. Beside the path from the body to the core, subtrees
whose density reaches the least density on that path are part of the article too, and so are headings before the core and
beside its block.

Text is given block by block in page order: character references are decoded, white space within a block is one
space, blocks are joined by a line break. Whole pages are read, whatever their length or depth; a page's cost is
linear in it. Malformed markup (missing end tags, stray end tags, cut-off pages) is read as far as it goes; behind a
quoted value that never closes, tags end at the first `>`. A closing slash counts inside svg and math alone.

Defined results: a null or empty page, or one without text outside boilerplate, gives an empty text; equal pages give
equal texts; of equal density sums the first in page order wins; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.llm.support import map_arrow

_OPEN = re.compile(r"<(?:(?P<comment>!--)|(?P<other>[!?])|(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*))")
#: The rest of a tag. A quote opens a value only behind an equals sign.
_REST = re.compile(r"""(?P<attrs>(?:[^=>]|=\s*"[^"]*"|=\s*'[^']*'|=(?!\s*["']))*+)>""")
#: A slash that is no part of an unquoted value.
_CLOSED = re.compile(r"""(?:^|[\s"'])/\Z""")
#: Attributes one after another, so that a value is never read as a name.
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s"'>][^\s>]*))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
FOREIGN = frozenset(("svg", "math"))
#: An open element of the value's names ends where the key begins, unless a container of it lies between.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
CONTAINERS = frozenset("ul ol dl table select body html article section main div".split())
CUT_TAGS = frozenset(
    "head script style noscript template iframe svg canvas object button select textarea dialog "
    "title menu noembed noframes audio video map".split()
)
NAMED_TAGS = frozenset("nav header footer aside form".split())
CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CUT_NAMES = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement advertising sponsor "
    "sponsored promo promotion banner notice cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login "
    "comment comments commentlist reply replies respond disqus discussion share sharing social related recommended breadcrumb "
    "breadcrumbs pagination pager search toolbar widget skip".split()
)
#: Names that articles' own parts seldom have.
OTHER = frozenset(
    "hidden nav navbar navigation masthead footer contentinfo complementary dialog alertdialog menubar sidebar aside ad ads "
    "advert adverts advertisement advertising sponsor sponsored promo cookie cookies consent gdpr popup modal newsletter signup "
    "login comment comments commentlist replies disqus sharing social breadcrumb breadcrumbs pagination pager toolbar skip".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
LINKED = 1 / 3
#: A name tells nothing where it covers more than this of the text, for names in OTHER more than the second.
MOST, NEARLY_ALL = 0.5, 0.95
#: An `article` or `main` counts as the page's from this share of the text without names.
LEAST_MAIN = 0.25


def _names(tag: str, attrs: str) -> frozenset[str]:
    """The words by which an element names itself as something else than the article."""
    found = {tag} if tag in NAMED_TAGS else set()
    if "=" not in attrs and "hidden" not in attrs.lower():
        return frozenset(found)
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            found.add("hidden")
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            found.add("hidden")
        elif name == "role" and value.lower() in CUT_ROLES:
            found.add(value.lower())
        elif name in ("class", "id"):
            found.update(w for w in map(str.lower, _WORDS.findall(value)) if w in CUT_NAMES)
    return frozenset(found)


class Page:
    """The tree of a page as parallel lists in page order; node 0 is the root. events: text pieces (node, text) and, for
    block borders, (node, None)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.first, self.last, self.names = ["html"], [-1], [0], [0], [frozenset()]
        self.events: list[tuple[int, str | None]] = []
        self._read(source)

    def _text(self, node: int, text: str) -> None:
        if text:
            self.events.append((node, entities.unescape(text) if "&" in text else text))

    def _read(self, source: str) -> None:
        stack, at, end = [0], 0, len(source)
        open_tags: Counter[str] = Counter()

        def close(depth: int) -> None:
            while len(stack) > depth:
                node = stack.pop()
                open_tags[self.tag[node]] -= 1
                if self.tag[node] not in INLINE:
                    self.events.append((node, None))
                self.last[node] = len(self.events)

        # beyond the last > nothing is a tag
        last, quotes = source.rfind(">"), True
        while at < end:
            m = _OPEN.search(source, at)
            if not m or (not m["comment"] and m.end() > last):
                self._text(stack[-1], source[at:])
                break
            self._text(stack[-1], source[at : m.start()])
            if m["comment"]:
                at = source.find("-->", m.end())
                at = at + 3 if at >= 0 else end
                continue
            rest = _REST.match(source, m.end()) if quotes and not m["other"] else None
            if rest:
                attrs, at = rest["attrs"], rest.end()
            else:  # a value without its closing quote; from here on quotes tell nothing
                quotes = quotes and bool(m["other"])
                at = source.index(">", m.end()) + 1
                attrs = source[m.end() : at - 1]
            if m["other"]:
                continue
            tag, closing = m["tag"].lower(), m["end"]
            if closing:
                inline = tag in INLINE
                for depth in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                    name = self.tag[stack[depth]]
                    if name == tag:
                        close(depth)
                        break
                    if inline and name not in INLINE:
                        break
                continue
            if tag in ("html", "body") and tag in (self.tag[n] for n in stack[:3]):
                continue
            ends = ENDS.get(tag, ())
            may_end = (tag not in INLINE and open_tags["p"]) or any(open_tags[x] for x in ends)
            for depth in range(len(stack) - 1, 0, -1) if may_end else ():
                name = self.tag[stack[depth]]
                if name in ends or (name == "p" and tag not in INLINE):
                    close(depth)
                    if name == "p":
                        break
                elif name in CONTAINERS or (not ends and name not in INLINE):
                    break
            node = len(self.tag)
            self.tag.append(tag)
            self.parent.append(stack[-1])
            self.names.append(frozenset() if tag in ("html", "body") else _names(tag, attrs))
            if tag not in INLINE or tag == "br":
                self.events.append((node, " " if tag == "br" else None))
            self.first.append(len(self.events))
            self.last.append(len(self.events))
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                at = stop.end() if stop else end
            elif tag not in VOID and not (attrs.endswith("/") and _CLOSED.search(attrs) and (tag in FOREIGN or any(open_tags[x] for x in FOREIGN))):
                stack.append(node)
                open_tags[tag] += 1
        close(1)
        self.last[0] = len(self.events)

    def _measures(self, gone: list[bool]) -> tuple[list[int], list[int], list[int], list[int]]:
        """Characters, those in links, tags and link tags of each subtree, without what is gone."""
        n = len(self.tag)
        chars, links, tags, link_tags = [0] * n, [0] * n, [1] * n, [0] * n
        in_link = [False] * n
        for i in range(1, n):
            in_link[i] = in_link[self.parent[i]] or self.tag[i] == "a"
            link_tags[i] = int(self.tag[i] == "a")
        for node, text in self.events:
            if text and not gone[node]:
                size = len(text) - text.count(" ") - text.count("\n")
                chars[node] += size
                links[node] += size if in_link[node] else 0
        for i in range(n - 1, 0, -1):
            if not gone[i]:
                p = self.parent[i]
                for of in (chars, links, tags, link_tags):
                    of[p] += of[i]
        return chars, links, tags, link_tags

    def _with_ancestors(self, node: int) -> set[int]:
        out = set()
        while node >= 0:
            out.add(node)
            node = self.parent[node]
        return out

    def _gone(self) -> list[bool]:
        """What is no part of the article by its element, or by its name where place or density agrees."""
        n, tag, parent, names = len(self.tag), self.tag, self.parent, self.names
        never = [False] * n
        for i in range(1, n):
            never[i] = never[parent[i]] or tag[i] in CUT_TAGS
        if not any(names):
            return never
        chars, links, tags, _ = self._measures(never)
        plain = [c - lc for c, lc in zip(chars, links)]
        under = [False] * n  # a named block
        for i in range(1, n):
            under[i] = under[parent[i]] or bool(names[i])
        out = [x or y for x, y in zip(never, under)]
        chars_out, links_out, *_ = self._measures(out)
        unnamed = chars_out[0] - links_out[0]
        scope, best = 0, 0
        for i in range(1, n):
            if tag[i] in MAIN and not never[i]:
                # inside a named block only one with more text than all that has no name
                size = plain[i] if not under[i] or plain[i] > unnamed else 0
                if size > best:
                    scope, best = i, size
        if scope and not under[scope] and plain[scope] < LEAST_MAIN * unnamed:
            scope = 0
        covers: dict[str, int] = {}
        active: list[frozenset[str]] = [frozenset()] * n
        inside = [i == scope for i in range(n)]
        for i in range(1, n):
            inside[i] = inside[i] or inside[parent[i]]
            active[i] = active[parent[i]]
            if inside[i] and names[i] and not never[i]:
                for w in names[i] - active[i]:
                    covers[w] = covers.get(w, 0) + plain[i]
                active[i] |= names[i]
        telling = {w for w, size in covers.items() if size <= (NEARLY_ALL if w in OTHER else MOST) * max(plain[scope], 1)}
        named = [names[i] & telling if inside[i] else names[i] for i in range(n)]
        if not scope:
            gone = list(never)
            for i in range(1, n):
                gone[i] = gone[i] or gone[parent[i]] or bool(named[i])
            scope = self._core(gone)[0]
        spared = self._with_ancestors(scope)
        has_title = [t in ("h1", "h2", "h3") for t in tag]
        for i in range(n - 1, 0, -1):
            has_title[parent[i]] |= has_title[i]
        inside, free, in_main = [i == scope for i in range(n)], [not x for x in never], [False] * n
        for i in range(1, n):
            inside[i] = inside[i] or inside[parent[i]]
            in_main[i] = in_main[parent[i]] or tag[parent[i]] in MAIN
            if tag[i] == "header" and in_main[i] and has_title[i]:
                named[i] -= {"header"}
            free[i] = free[i] and free[parent[i]] and (i in spared or not named[i])
        # the article's own text: how dense, and from where to where
        own, start, end = 0, len(self.events), 0
        for k in range(self.first[scope], self.last[scope]):
            node, text = self.events[k]
            if text and free[node] and not text.isspace():
                own += len(text) - text.count(" ") - text.count("\n")
                start, end = min(start, k), k
        own /= max(sum(free[i] and inside[i] for i in range(n)), 1)
        gone = list(never)
        for i in range(1, n):
            cut = False
            if named[i] and i not in spared and not never[i]:
                dense = chars[i] / tags[i]
                edge = self.last[i] <= start or self.first[i] > end
                other = bool(named[i] & OTHER)
                cut = not inside[i] or "hidden" in named[i] or links[i] >= LINKED * chars[i] or dense < (own if other else own / 2)
                cut = cut or (edge and (other or tag[scope] not in MAIN))
            gone[i] = gone[i] or gone[parent[i]] or cut
        return gone

    def main_text(self) -> str:
        gone = self._gone()
        return self._text_of(self._core(gone)[1], gone)

    def _core(self, gone: list[bool]) -> tuple[int, list[int]]:
        """The core of the article, and the nodes that make up the article with it in page order."""
        n = len(self.tag)
        chars, links, tags, link_tags = self._measures(gone)
        body = next((i for i in range(n) if self.tag[i] == "body" and not gone[i]), 0)
        share = links[body] / max(chars[body], 1)
        density, sums = [0.0] * n, [0.0] * n
        for i in range(n - 1, -1, -1):
            if gone[i] or not chars[i]:
                continue
            c, lc, t, lt = chars[i], links[i], tags[i], link_tags[i]
            base = math.log(c / max(c - lc, 1) * lc + share * c + math.e)
            # the outer logarithm has the base `base`, which is at least 1; a node of nothing but one link gets zero
            weight = math.log(max(c / max(lc, 1) * t / max(lt, 1), 1.0))
            density[i] = c / t * weight / max(math.log(base), 1e-2)
            if i:
                sums[self.parent[i]] += density[i]
        core = body
        for i in range(body, n):
            if not gone[i] and sums[i] > sums[core]:
                core = i
        path = [core]
        while path[-1] != body and self.parent[path[-1]] >= 0:
            path.append(self.parent[path[-1]])
        least = min(density[i] for i in path)
        named = [i for i in path if self.tag[i] in ("article", "main")]
        if named:
            core = named[-1]
        on_path = set(path[path.index(core) :])
        # the block that holds the core, whose headings stand before it
        block = next((i for i in path[path.index(core) :] if self.tag[i] not in INLINE), core)
        chosen = [core] + [
            i for i in range(n)
            if self.parent[i] in on_path and self.parent[i] != core and i not in on_path and not gone[i] and chars[i]
            and (density[i] >= least or (i < core and self.tag[i] in HEADINGS and self.parent[i] == self.parent[block]))
        ]
        return core, sorted(chosen)

    def _text_of(self, chosen: list[int], gone: list[bool]) -> str:
        blocks, line, upto = [], [], 0

        def end_block() -> None:
            text = " ".join("".join(line).split())
            if text:
                blocks.append(text)
            line.clear()

        for node in chosen:
            end_block()
            for k in range(max(upto, self.first[node]), self.last[node]):
                at, text = self.events[k]
                if text is None:
                    end_block()
                elif not gone[at]:
                    line.append(text)
            upto = max(upto, self.last[node])
        end_block()
        return "\n".join(blocks)


def main_text(source: str | None) -> str:
    """The main text of one page."""
    return Page(source).main_text() if source else ""


def extract_main_text(pages: DataFrame, *, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """`keep`, text and n_chars, one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [*keep, "text", "n_chars"],
            )

    kept = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(pages.select(*[F.col(c) for c in keep], F.col(html).alias("__html")), run, f"{kept}, text string, n_chars long")
