"""Main text of a page by composite text density.

Every node gets its density: characters per tag, weakened by the share of them that stands in links. The node
with the largest sum of its children's densities is the core; the lowest density on its path up to the body is
the threshold. In a page with articles the main text is the outermost article around the core, else the main
element around it. In a page without, it is the core's subtree, the words of the nodes on its path, all nodes
beside the path that reach two thirds of the mean density of the core's children (by their characters), and
the headings right before any of these; unnamed menus, tag lines and footers do not. (The composite density
grows with the size of a node: no single paragraph reaches the path's threshold in a page without links, so
blocks are held against blocks.) Lists and boxes of links below the threshold are dropped, and as a second
rule so are elements that by name, role or class are no text of an article (menus, headers, footers, sidebars,
notices, adverts, forms, comments). A class or id counts as a whole token, and never on an article or main
element. Such an element stays if it holds most of the page's text and all of its article text, or nearly all
text of the article that it lies in. What is never shown (scripts, styles, templates, hidden elements) has no
text.

One pass per page without recursion, so deep and long pages are safe. Defined results: a null or empty page
has no text; text without any element is one block; unclosed and crossing tags are closed as browsers do in
simple cases; malformed declarations (`<![x[y]]>`) are comments. Repeated rows get equal results. Further
columns are not read.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

# Element names and class words.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr img br ruby rt rp math mi mn mo ms mtext mspace mrow mfrac msqrt mroot msub msup "
    "msubsup mover munder munderover mtable mtr mtd mstyle mpadded mphantom mfenced semantics".split()
)
UNSEEN = set(
    "head script style noscript template iframe svg canvas object button select textarea audio video map title "
    "annotation annotation-xml".split()
)
ASIDE = set("nav footer aside form dialog menu".split())
IN_HEAD = set("title meta link script style base noscript template".split())
BOILERPLATE = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|"
    r"sidebar|side-bar|rail|menu|nav|navbar|navigation|breadcrumbs?|pagination|pager|footer|header|masthead|"
    r"comments?|replies|respond|disqus|share|sharing|social|related|recommended|newsletter|subscribe|"
    r"signup|login|search|toolbar|widget|tags|hidden|"
    r"(site|main|global|top|left|right|primary|secondary)[-_](footer|nav|navbar|navigation|menu|sidebar|rail|banner)|"
    r"site[-_]header|ad[-_](slot|unit|container|banner|box|wrapper)|(cookie|consent|gdpr)[-_](banner|notice|bar|popup|overlay)|"
    r"(share|social)[-_](buttons|links|bar|icons)|comments?[-_](list|form|section|area|thread)|related[-_](posts|articles|links)"
)
ROLES = set("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
#: A start of the first closes an open element of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = set("ul ol dl table body html div article section main td th".split())
BOXES = set("div section ul ol dl table".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())


class Page(HTMLParser):
    """Nodes in page order: parent, name, and texts with the node that they lie in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parent, self.name, self.open = [-1], ["body"], [0]
        self.items: list[tuple[int, str | None]] = []  # (node, text), or (node, None) where a node begins or ends
        self.unwanted: list[str] = [""]  # "unseen" or "aside", or nothing

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        in_body = tag == "body" or len(self.open) == 2 and tag not in IN_HEAD
        if in_body and len(self.open) > 1 and self.name[self.open[1]] == "head":
            del self.open[1:]
        if tag in ("html", "body"):
            return
        if tag not in INLINE:
            self._close({"p"}, SCOPES)
        if tag in CLOSES:
            self._close(CLOSES[tag], SCOPES - {"td", "th"} if tag == "tr" else SCOPES - CLOSES[tag])
        node = len(self.parent)
        self.parent.append(self.open[-1])
        self.name.append(tag)
        self.unwanted.append(self._unwanted(tag, dict(attrs)))
        self.items.append((node, None))
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or tag in ("html", "body"):
            return
        self._close({tag}, set() if tag not in INLINE else SCOPES)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """`<![word[ ...>` is a comment up to its `>` or the end, as in browsers; the base class fails on unknown words."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else len(self.rawdata)

    def handle_data(self, data: str) -> None:
        self.items.append((self.open[-1], data))

    def _unwanted(self, tag: str, attrs: dict[str, str | None]) -> str:
        if tag in UNSEEN or "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return "unseen"
        if tag in ("article", "main"):
            return ""
        if tag in ASIDE or tag == "header" and not any(self.name[n] in ("article", "main") for n in self.open):
            return "aside"
        if (attrs.get("role") or "").lower() in ROLES:
            return "aside"
        named = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split()
        return "aside" if any(map(BOILERPLATE.fullmatch, named)) else ""

    def _close(self, names: set[str], stop: set[str]) -> None:
        """Close the innermost open element of `names`, with all in it, unless one of `stop` lies between."""
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.name[self.open[depth]]
            if name in names:
                self.items.append((self.open[depth], None))
                del self.open[depth:]
                return
            if name in stop:
                return


def _left_out(page: Page) -> list[bool]:
    """Whether a node is no text of an article, by itself or by what it lies in."""
    n = len(page.parent)
    gone, size, story, scope = [False] * n, [0] * n, [0] * n, [0] * n
    for i in range(1, n):
        up = page.parent[i]
        gone[i] = page.unwanted[i] == "unseen" or gone[up]
        scope[i] = up if page.name[up] in ("article", "main") else scope[up]
    for node, text in page.items:
        if text is not None and not gone[node]:
            size[node] += len(text.strip())
    for i in range(n - 1, 0, -1):
        if page.name[i] in ("article", "main"):
            story[i] = size[i]
        size[page.parent[i]] += size[i]
        story[page.parent[i]] += story[i]
    for i in range(1, n):
        aside = page.unwanted[i] == "aside"
        if aside and scope[i]:
            aside = 10 * size[i] <= 9 * size[scope[i]]
        elif aside:
            aside = 2 * size[i] <= size[0] or story[i] < story[0]
        gone[i] = gone[i] or aside or gone[page.parent[i]]
    return gone


def _densities(page: Page, gone: list[bool]) -> tuple[list[float], list[float], list[int], list[int], list[int]]:
    n = len(page.parent)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = page.name[i] == "a" or in_link[page.parent[i]]
    for node, text in page.items:
        if text is not None and not gone[node]:
            size = len(text.strip())
            chars[node] += size
            if in_link[node]:
                link_chars[node] += size
    for i in range(n - 1, 0, -1):
        if gone[i]:
            continue
        up = page.parent[i]
        chars[up] += chars[i]
        link_chars[up] += link_chars[i]
        tags[up] += tags[i] + 1
        link_tags[up] += link_tags[i] + (page.name[i] == "a")
    body_ratio = link_chars[0] / max(1, chars[0])
    density = [0.0] * n
    for i in range(n):
        c, t = chars[i], max(1, tags[i])
        if not c:
            continue
        lc, lt = link_chars[i], link_tags[i]
        base = math.log(c / max(1, c - lc) * lc + body_ratio * c + math.e)
        adjusted = c / max(1, lc) * t / max(1, lt)
        # The base of the logarithm is at least 1; nearer to 1 than this it is held there.
        density[i] = c / t * math.log(max(adjusted, 1.0)) / math.log(max(base, 1.001))
    sums = [0.0] * n
    for i in range(1, n):
        sums[page.parent[i]] += density[i]
    return density, sums, chars, link_chars, link_tags


def _by_threshold(
    page: Page, gone: list[bool], density: list[float], chars: list[int], path: list[int], least: float
) -> list[bool]:
    """The main text of a page without article: the core, what reaches the least density, and headings right before them.

    Nodes of the path hold both text and other things: they count for their own words only.
    """
    n, core, on_path = len(page.parent), path[0], set(path)
    whole = [False] * n
    headed = [0] * n  # characters in headings
    for i in range(1, n):
        loose = i not in on_path and (density[i] >= least or page.name[i] in INLINE - {"a"} and page.parent[i] in on_path)
        whole[i] = i == core or whole[page.parent[i]] or loose
    for i in range(n - 1, 0, -1):
        headed[i] = chars[i] if page.name[i] in HEADINGS else headed[i]
        headed[page.parent[i]] += headed[i]
    following: dict[int, int] = {}  # of each parent, the sibling after the one in work
    for i in range(n - 1, 0, -1):
        after = following.get(page.parent[i])
        if after is not None and 0 < headed[i] == chars[i] and (whole[after] or after in on_path):
            whole[i] = True
        if not gone[i] and chars[i]:
            following[page.parent[i]] = i
    for i in range(1, n):
        whole[i] = whole[i] or whole[page.parent[i]]
    return [whole[i] or i in on_path for i in range(n)]


def extract(html: str) -> str:
    page = Page()
    page.feed(html)
    page.close()
    gone = _left_out(page)
    density, sums, chars, link_chars, link_tags = _densities(page, gone)
    if not chars[0]:
        return ""
    core = max(range(len(sums)), key=lambda i: (sums[i], density[i], -i))
    path = [core]
    while path[-1]:
        path.append(page.parent[path[-1]])
    threshold = min(density[i] for i in path)
    root = next((i for name in ("article", "main") for i in reversed(path) if page.name[i] == name), 0)
    n = len(page.parent)
    if root or not core:
        picked = [i == root for i in range(n)]
        for i in range(root + 1, n):
            picked[i] = picked[page.parent[i]]
    else:
        blocks_of = [i for i in range(n) if page.parent[i] == core and not gone[i]]
        mean = sum(density[i] * chars[i] for i in blocks_of) / max(1, sum(chars[i] for i in blocks_of))
        picked = _by_threshold(page, gone, density, chars, path, mean * 2 / 3)
    inside = [False] * n
    inside[root] = picked[root]
    for i in range(root + 1, n):
        links_box = page.name[i] in BOXES and link_tags[i] > 1 and density[i] < threshold and 2 * link_chars[i] > chars[i]
        inside[i] = picked[i] and inside[page.parent[i]] and not gone[i] and not links_box
    blocks: list[str] = []
    current: list[str] = []
    for node, text in page.items:
        if text is not None:
            if inside[node]:
                current.append(text)
        elif gone[node]:
            continue
        elif page.name[node] == "br":
            current.append(" ")
        elif page.name[node] not in INLINE:
            blocks.append("".join(current))
            current = []
    blocks.append("".join(current))
    joined = (" ".join(block.split()) for block in blocks)
    return "\n".join(block for block in joined if block)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches):
        for batch in batches:
            texts = [extract(html) if html else "" for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
