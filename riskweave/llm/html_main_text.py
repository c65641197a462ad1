"""Main text of web pages as the maximum-scoring subsequence of words and tags.

A page becomes a sequence of words, which score positive, and tags, which score
negative; one linear scan finds the contiguous region with the highest sum. The scores
are trained here with a perceptron on a bounded sample of pages that mark their own
content with one ``article`` or ``main`` element: the features of the marked region are
rewarded, those of the region found are punished, and the signs are kept.
Scripts, styles, menus, forms, adverts, comments and the like count for nothing, tags
included, unless one wraps the whole page. The region found is then completed to whole
blocks, with the text blocks next to it, so that short list items, headings and closing
sentences stay.

Defined cases: null or empty html gives an empty text, an empty table no rows; optional end
tags are supplied; other unclosed elements end with their parent, and unclosed chrome at its
first inner block; a page without a positive region gives an empty text; without pages that
mark their content the starting weights are used; of equal scores the first region counts;
equal pages are each a row; texts have no limit of length; further columns pass through, but
an existing ``text`` column is replaced.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the markup language.
_RAW = "script|style|noscript|template|title|textarea|select|button|iframe|svg|object"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S | re.I)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
_OUTSIDE = frozenset("nav aside footer form menu head dialog fieldset".split())
#: Elements that are chrome whatever they hold; the others of _OUTSIDE may also wrap a whole page.
_ALWAYS = frozenset("nav footer menu head".split())
#: A name with one of these parts marks chrome.
_STRONG = re.compile(r"ads?|advert\w*|consent|cookies?|disqus|newsletter|popup|promo\w*|sponsor\w*|subscribe", re.I)
#: These mark chrome if the rest of the name is layout words: "comment-list", but not "related-work".
_WEAK = re.compile(r"banner|breadcrumbs?|comments?|footer|header|menu|nav\w*|notice|related|shar(?:e|ing)|sidebar|social|toolbar|widget", re.I)
_LAYOUT = frozenset(
    "area article articles bar block bottom box buttons container content entry global icons inner items left legal links list main "
    "outer page post posts primary reader right secondary section site slot stories story text thread title top unit user wrap wrapper".split())
#: Blocks that continue a text next to them, and elements inside a line.
_CONTENT = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl li dt dd table tbody thead tfoot tr td th caption blockquote pre figure figcaption address".split())
_INLINE = frozenset("a abbr b bdi bdo big cite code del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Optional end tags: an opening tag ends the open elements of the first set, up to one of the second.
_ENDS = {
    "li": ({"li", "p"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}), "tr": ({"td", "th", "tr", "p"}, {"table"}),
    "tbody": ({"td", "th", "tr", "tbody", "thead", "p"}, {"table"}), "tfoot": ({"td", "th", "tr", "tbody", "thead", "p"}, {"table"}),
    "body": ({"head"}, set()),
}
_ENDED_BY_BLOCK = ({"p"}, {"li", "dd", "td", "th", "div", "blockquote", "section", "article", "main", "table", "body"})
_OPTIONAL = frozenset("p li dt dd td th tr tbody thead tfoot head body html".split())
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

WORD, LINKED = "word", "linked word"
#: Weights before training; a tag that is not listed has the weight of "other".
START = {
    WORD: 1.0, LINKED: 0.2, "other": -1.0, "p": -0.5, "br": -0.3, "b": -0.3, "i": -0.3, "em": -0.3, "strong": -0.3, "h1": -0.5,
    "h2": -0.5, "h3": -0.5, "a": -2.0, "li": -1.5, "ul": -2.0, "nav": -12.0, "footer": -12.0, "aside": -12.0, "form": -12.0,
    "header": -6.0, "div": -3.0, "td": -1.0, "head": -12.0, "body": -3.0, "article": -3.0, "main": -3.0, "section": -2.0,
}
MARKED = "<article[ >]|<main[ >]"


class Element:
    """A stretch of tokens: ``low`` is its opening tag, ``high`` follows its last token."""
    __slots__ = ("name", "names", "low", "high", "up", "closed", "words", "linked", "out")

    def __init__(self, name: str, names: str, low: int, up: Element | None):
        self.name, self.names, self.low, self.up = name, names, low, up
        self.high, self.closed, self.words, self.linked, self.out = low, False, 0, 0, False


def _is_chrome(names: str) -> bool:
    for name in names.split():
        parts = [x for x in re.split(r"[_-]+", name.lower()) if x]
        if any(_STRONG.fullmatch(x) for x in parts) or any(_WEAK.fullmatch(x) for x in parts) and all(
                _WEAK.fullmatch(x) or x in _LAYOUT or x[0].isdigit() for x in parts):
            return True
    return False


def read(page: str) -> tuple[list[tuple[str, int, str, bool]], list[Element], list[Element]]:
    """Tokens (feature, count, text, block start), the element of each token, and the elements in the order of their start."""
    tokens: list[tuple[str, int, str, bool]] = []
    root = Element("", "", 0, None)
    stack, owners, elements = [root], [], [root]
    open_names: dict[str, int] = {}

    def close(depth: int, properly: bool = False) -> None:
        while len(stack) > depth:
            last = stack.pop()
            open_names[last.name] -= 1
            last.high, last.closed = len(tokens), last.name in _OPTIONAL or properly and len(stack) == depth

    def end_optional(ended: set, borders: set) -> None:
        if not any(open_names.get(x) for x in ended):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in borders:
                break
            if stack[depth].name in ended:
                close(depth)

    links = 0
    for m in _TOKEN.finditer(page):
        name = (m[3] or "").lower()
        if name:
            if m[2] == "/":
                depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].name == name), 0) if open_names.get(name) else 0
                links = 0 if name == "a" else links
                owners.append(stack[depth] if depth else stack[-1])
                tokens.append((name, 1, "", name in _BLOCKS))
                if depth:
                    close(depth, properly=True)
                continue
            if name in _BLOCKS:
                end_optional(*_ENDS.get(name, _ENDED_BY_BLOCK))
            elif name in _ENDS:
                end_optional(*_ENDS[name])
            links = 1 if name == "a" else links
            if name not in _VOID:
                stack.append(Element(name, " ".join(a or b or c for a, b, c in _NAMES.findall(m[4])), len(tokens), stack[-1]))
                elements.append(stack[-1])
                open_names[name] = open_names.get(name, 0) + 1
            owners.append(stack[-1])
            tokens.append((name, 1, "", name in _BLOCKS))
        elif m[1] or m[0].startswith("<!") or m[0].startswith("<?"):
            owners.append(stack[-1])
            tokens.append(("other", 0, "", False))
        else:
            text = html.unescape(m[0])
            owners.append(stack[-1])
            tokens.append((LINKED if links else WORD, len(text.split()), text, False))
    close(1)
    root.high = len(tokens)
    for (feature, count, text, _), owner in zip(tokens, owners):
        if text:
            owner.words += count
            owner.linked += count if feature == LINKED else 0
    for element in reversed(elements[1:]):
        element.up.words += element.words
        element.up.linked += element.linked
    _mark_chrome(tokens, elements)
    return tokens, owners, elements


def _mark_chrome(tokens: list, elements: list[Element]) -> None:
    """Sets ``out`` on menus, adverts and the like and on all in them, but not on what wraps the whole page."""
    total = elements[0].words
    titled = [e.low for e in elements if e.name in ("h1", "article", "main")]
    candidates = [e for e in elements[1:] if e.name in _OUTSIDE or e.name not in ("body", "html", "article", "main")
                  and e.names and _is_chrome(e.names)]
    for e in candidates:
        if not e.closed:  # its end is unknown: it reaches to its first inner block
            first = next((at for at in range(e.low + 1, e.high) if tokens[at][3]), e.high)
            e.high = first
        elif e.name not in _ALWAYS:
            rest = total - e.words
            if not rest and e.words >= 50 or rest * 10 < e.words and any(e.low < at < e.high for at in titled):
                continue
        e.out = True
    covered = 0
    for e in elements[1:]:
        if e.low < covered:
            e.out = True
        elif e.out:
            covered = e.high


def parse(page: str) -> tuple[list[tuple[str, int, str, bool]], tuple[int, int] | None]:
    """Tokens for the scan, chrome counting for nothing, and the token range of the one marked element, if there is one."""
    tokens, _, elements = read(page)
    return _without_chrome(tokens, elements), _marked(elements)


def _without_chrome(tokens: list, elements: list[Element]) -> list:
    tokens = list(tokens)
    for e in elements:
        if e.out:
            tokens[e.low:e.high] = [("other", 0, "", block) for _, _, _, block in tokens[e.low:e.high]]
    return tokens


def _marked(elements: list[Element]) -> tuple[int, int] | None:
    spans = [(e.low + 1, e.high - 1 if e.closed else e.high) for e in elements
             if e.name in ("article", "main") and not e.out]
    outer: list[tuple[int, int]] = []
    for span in spans:
        if not outer or span[0] >= outer[-1][1]:
            outer.append(span)
    return outer[0] if len(outer) == 1 else None


def whole_blocks(found: tuple[int, int], tokens: list, owners: list[Element], elements: list[Element]) -> tuple[int, int]:
    """The region with its first and last block whole and the text blocks next to it.

    The blocks are the children of the innermost element around the region that is no text
    block itself. Neighbours follow as long as they are text blocks with fewer words in links
    than outside, or look like a block of the region; a heading at the end whose section is
    chrome is left off.
    """
    low, high = found
    if low == high:
        return found
    home = owners[low]
    while home.up is not None and (home.high < high or home.low > low or home.name in _INLINE or home.name in _CONTENT and not (
            home.name == "td" and home.words * 2 > elements[0].words)):
        home = home.up
    units: list[tuple[int, int, Element | None]] = []
    at = home.low + 1 if home.up is not None else home.low
    children = iter([e for e in elements if e.up is home])
    child = next(children, None)
    while at < home.high:
        if child is not None and child.low == at:
            # Text behind a cut-off chrome element is a unit without an element.
            units.append((at, child.high, child))
            at, child = max(child.high, at + 1), next(children, None)
        else:
            units.append((at, at + 1, None))
            at += 1
    inside = [n for n, (a, b, _) in enumerate(units) if a < high and b > low]
    if not inside:
        return found
    first, last = inside[0], inside[-1]
    alike = {(e.name, e.names) for _, _, e in units[first:last + 1] if e is not None}

    def follows(unit: tuple[int, int, Element | None]) -> bool:
        a, _, e = unit
        if e is None:
            return home.name != "body" and home.up is not None or not tokens[a][2].strip()
        return e.out or (e.name in _CONTENT or e.name in _INLINE or (e.name, e.names) in alike) and e.linked * 2 <= e.words

    def blank(n: int) -> bool:
        return units[n][2] is None and not tokens[units[n][0]][2].strip()

    start, end = first, last
    while start > 0 and follows(units[start - 1]):
        start -= 1
    while end + 1 < len(units) and follows(units[end + 1]):
        end += 1
    # Headings whose section is chrome.
    following = next((n for n in range(end + 1, len(units)) if not blank(n)), None)
    chrome, kept_end = following is not None and units[following][2] is not None and units[following][2].out, end
    while kept_end > start and (blank(kept_end) or units[kept_end][2] is not None and (
            units[kept_end][2].out or chrome and units[kept_end][2].name in _HEADINGS)):
        chrome = chrome or units[kept_end][2] is not None and units[kept_end][2].out
        kept_end -= 1

    def whole(n: int) -> bool:
        return n < first or n > last or units[n][2] is None or units[n][2].name in _CONTENT or units[n][2].name in _INLINE

    begin = units[start][0] if whole(start) else low
    if kept_end < last:
        return begin, units[kept_end][1]
    return begin, units[kept_end][1] if whole(kept_end) else high


def best_region(tokens: list, weights: dict[str, float]) -> tuple[int, int]:
    """The half-open range with the highest sum, the first of equals; empty if no sum is positive."""
    other, best, total, begin, found = weights["other"], 0.0, 0.0, 0, (0, 0)
    for at, (feature, count, _, _) in enumerate(tokens):
        if total <= 0:
            total, begin = 0.0, at
        total += weights.get(feature, other) * count
        if total > best:
            best, found = total, (begin, at + 1)
    return found


def train(pages: list[str], rounds: int = 5, rate: float = 0.05) -> dict[str, float]:
    """Perceptron over pages with one marked element; words stay positive, tags negative."""
    weights, marked = dict(START), [p for p in map(parse, pages) if p[1]]
    for _ in range(rounds):
        wrong = 0
        for tokens, (low, high) in marked:
            a, b = best_region(tokens, weights)
            counts: dict[str, int] = {}
            for at, (feature, count, _, _) in enumerate(tokens):
                sign = (low <= at < high) - (a <= at < b)
                if sign and count:
                    counts[feature] = counts.get(feature, 0) + sign * count
            wrong += any(counts.values())
            for feature, count in counts.items():
                step = rate * max(-10, min(10, count))
                moved = weights.get(feature, weights["other"]) + step
                weights[feature] = max(0.05, moved) if feature in (WORD, LINKED) else min(-0.01, moved)
        if not wrong:
            break
    return weights


def main_text(page: str | None, weights: dict[str, float]) -> str:
    tokens, owners, elements = read(page or "")
    tokens = _without_chrome(tokens, elements)
    low, high = whole_blocks(best_region(tokens, weights), tokens, owners, elements)
    blocks, part = [], []
    for feature, _, text, block in tokens[low:high]:
        if block:
            blocks.append("".join(part))
            part = []
        elif text:
            part.append(text)
        elif feature in ("br", "td", "th"):
            part.append(" ")
    blocks.append("".join(part))
    return "\n".join(t for t in (" ".join(b.split()) for b in blocks) if t)


def fitted_weights(pages: DataFrame, sample: int = 400, longest: int = 100_000) -> dict[str, float]:
    """Weights from at most ``sample`` marked pages of at most ``longest`` characters, chosen by a hash of their key."""
    marked = pages.where(F.col("html").rlike(MARKED) & (F.length("html") <= longest)).select(
        F.xxhash64("page_id").alias("_order"), F.xxhash64("html").alias("_page"), "html")
    # Keys first: a task then sends its few candidates without their pages.
    chosen = marked.select("_order", "_page").orderBy("_order", "_page").limit(sample)
    rows = marked.join(F.broadcast(chosen.distinct()), ["_order", "_page"]).select("html").limit(sample)
    return train(sorted(r[0] for r in rows.collect()))


def extract(pages: DataFrame, weights: dict[str, float] | None = None, column: str = "html") -> DataFrame:
    """Pages with ``text`` instead of the html column."""
    weights = weights or fitted_weights(pages)
    kept = [c for c in pages.columns if c not in (column, "text")]
    side = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(p, weights) for p in batch.column(len(kept)).to_pylist()], type=pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=batch.schema.names)
    return side.mapInArrow(run, side.schema)
