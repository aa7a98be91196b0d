"""Main text of web pages by minimum cut: blocks of text are content or boilerplate, whichever parts the page at the least cost.

A page is read once into blocks (text between block-level tags) and the elements that hold them. A linear classifier gives each block and each
marked element a score: what the tag names and the class, id and role words of an element say, how much of a block is link text, its length
and whether it ends like a sentence. Scores become capacities to the two terminals; neighbouring blocks are joined by an edge, and each block
and element with the element around it, weaker the more of the page lies between. The minimum cut keeps what remains on the content side.

The classifier is a fixed rule (no labelled pages are given); its words and weights are stated below. Decisions that no neighbour can turn are
taken out of the graph first; they are the same in every minimum cut, so that max-flow runs on the doubtful parts only. Where two cuts cost the same,
the one with the least content is taken.

What is never content, whatever its score: scripts, styles, head, form controls, embedded objects, hidden elements, markup. Character references
are decoded, white space inside a block becomes one blank, blocks are joined by a line feed in page order, and nothing else is dropped or cut.

Null, empty and blank pages and pages without tags: without any tag the whole page is one block of text; otherwise the text is empty where no
block is content. Tags that end at the end of the page only, or never, are read as browsers do, or dropped. Very long pages cost time in
proportion to their length but for the doubtful parts. Repeated rows and ids get their own results; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the page model and the classifier.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style textarea title xmp iframe noembed noframes noscript template svg math object audio video canvas map select option optgroup datalist button input".split()
)
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open element of the key ends before one of these begins, unless one of LISTS lies between.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}}
ENDING = frozenset().union(*ENDED_BY.values())
LISTS = frozenset("table ul ol dl menu body html".split())
CELLS, TABLE = frozenset("td th table".split()), frozenset("table tbody tfoot thead tr td th".split())
IN_HEAD = frozenset("title meta link style script base noscript template".split())
TAG_SCORE = {"article": 6.0, "main": 4.0, "nav": -12.0, "footer": -12.0, "aside": -12.0, "form": -12.0, "menu": -12.0, "dialog": -12.0, "header": -12.0, "fieldset": -12.0}
BAD = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs crumbs toc header masthead topbar toolbar footer foot copyright legal colophon sidebar aside rail widget widgets"
    " ad ads adv advert adverts advertisement advertising adsense dfp banner sponsor sponsored sponsors promo promos promotion promoted commercial"
    " cookie cookies consent gdpr notice notices notification alert warning popup modal overlay lightbox disclaimer"
    " comment comments commentlist respond reply replies disqus discussion reviews guestbook feedback"
    " share sharing social follow related recommended recommendations outbrain taboola newsletter subscribe subscription signup signin login register search form"
    " pagination pager paging skip tags tagcloud".split()
)
GOOD = frozenset("article articlebody post entry story content contents main maincontent body text prose".split())
ROLE = {"navigation": -12.0, "banner": -12.0, "contentinfo": -12.0, "complementary": -12.0, "search": -12.0, "form": -12.0, "alert": -12.0, "dialog": -12.0, "menu": -12.0, "menubar": -12.0, "main": 4.0, "article": 6.0}
BAD_WORD, GOOD_WORD = -12.0, 3.0
#: Words before which a class word says the opposite or nothing: "no-sidebar", "with-comments", "has-ads".
MODIFIERS = frozenset("no not without with has have is hide show".split())
#: Heads and feet of the article itself.
OWN_HEAD = frozenset("header head title".split())
#: Blocks: start value outside and inside marked content, for each word up to so many, for a closing sign, for link text outside and inside, in a heading, for the phrase of a notice.
OUTSIDE, INSIDE, PER_WORD, MOST_WORDS, SENTENCE, LINKS, LINKS_INSIDE, TITLE, CLAIM = -1.0, 1.0, 0.12, 40, 0.8, -6.0, -4.0, 0.6, -4.0
#: Share of the page's text from which a boilerplate word on the element around an article is not believed, but for comments.
MOST, COMMENTS = 0.6, frozenset("comment comments commentlist respond reply replies disqus discussion reviews guestbook feedback".split())
CLAIMS = re.compile(
    r"\xa9|\(c\) ?\d|all rights reserved|copyright|cookies|newsletter|subscribe|privacy policy|terms of (?:use|service)|sign (?:in|up)|log in|enable javascript|advertisement|sponsored",
    re.IGNORECASE,
)
#: Smoothness to the next block and to the element around, and units of a capacity.
NEXT, AROUND, SCALE = 0.5, 2.0, 1000

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?""")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_WANTED = frozenset(("class", "id", "role", "hidden", "style", "aria-hidden", "itemprop"))


class Element:
    __slots__ = ("around", "article", "bad", "dropped", "inside", "score", "size", "tag", "within", "word")

    def __init__(self, tag: str, around: Element | None, score: float = 0.0, dropped: bool = False, word: str = ""):
        self.tag, self.around, self.score, self.dropped, self.word = tag, around, score, dropped, word
        self.within = score > 0 or (score == 0 and around is not None and around.within)
        #: Blocks in it, signs outside links, whether an article is in it, the nearest boilerplate mark on or around it.
        self.inside, self.size, self.article, self.bad = 0, 0, tag in ("article", "main"), 0.0


class Block:
    __slots__ = ("element", "linked", "score", "size", "text")

    def __init__(self, element: Element, text: str, linked: int):
        self.element, self.text, self.linked, self.size, self.score = element, text, linked, len(text) - text.count(" "), 0.0


def _named(value: str) -> tuple[float, str]:
    """What the words of a class or id say, and the boilerplate word that decided, if one did."""
    score = 0.0
    for name in value.split():
        words = [w.lower() for w in _WORD.findall(name)]
        good = [k for k, w in enumerate(words) if w in GOOD]
        bad = [k for k, w in enumerate(words) if w in BAD and not MODIFIERS.intersection(words[:k])]
        if good and bad and all(words[k] in OWN_HEAD for k in bad):
            continue  # the head of the article itself
        if bad and not (good and good[-1] == len(words) - 1 and bad[0] > 0):
            return BAD_WORD, words[bad[0]]
        if good:
            score = GOOD_WORD
    return score, ""


def _element(tag: str, attributes: str, around: Element) -> Element:
    score, hidden, word = TAG_SCORE.get(tag, 0.0), False, ""
    if tag == "header" and around.within:
        score = 0.0
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name not in _WANTED:
                continue
            value = unescape(value.strip("\"'")) if name != "hidden" else ""
            said = 0.0
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                hidden = True
            elif name == "style":
                flat = value.lower().replace(" ", "")
                hidden |= "display:none" in flat or "visibility:hidden" in flat
            elif name == "role":
                said = ROLE.get(value.lower(), 0.0)
            elif tag not in ("html", "body", "main"):
                said, found = _named(value)
                word = word or found
            score = min(score, said) if said < 0 else max(score, said) if score >= 0 else score
    return Element(tag, around, score, hidden or tag in DROPPED or around.dropped, word)


def blocks_of(page: str) -> tuple[list[Block], list[Element]]:
    """The blocks of text of a page in order, without what is never content, and the elements in the order in which they begin."""
    stack, blocks, text = [Element("", None)], [], []
    elements = list(stack)
    linked = links = at = 0
    end, endless = len(page), {}

    def flush() -> None:
        nonlocal linked
        if text:
            if joined := " ".join("".join(text).split()):
                blocks.append(Block(stack[-1], joined, linked))
            text.clear()
        linked = 0

    def take(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1].dropped:
            raw = unescape(raw) if "&" in raw else raw
            text.append(raw)
            if links:
                linked += len("".join(raw.split()))

    def close(to: int) -> None:
        nonlocal links
        while len(stack) > to:
            if stack[-1].tag in BLOCK:
                flush()
            links -= stack.pop().tag == "a"

    def end_tag(tag: str) -> None:
        if tag in ("body", "html"):
            return flush()
        block = tag in BLOCK
        if block:
            flush()
        for k in range(len(stack) - 1, 0, -1):
            open_tag = stack[k].tag
            if open_tag == tag:
                return close(k)
            if (open_tag in CELLS and tag not in TABLE) if block else open_tag in BLOCK:
                return None

    def before(tag: str) -> None:
        """Ends what may not hold the element that begins."""
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            close(len(stack) - 1)
        if tag not in BLOCK:
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in BLOCK:
                if stack[k].tag == "p":
                    close(k)
                break
        if tag in ENDING:
            to = 0
            for k in range(len(stack) - 1, 0, -1):
                if tag in ENDED_BY.get(stack[k].tag, ()):
                    to = k
                elif stack[k].tag in LISTS:
                    break
            if to:
                close(to)
        flush()

    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            take(page[at:])
            break
        take(page[at:mark])
        following = page[mark + 1 : mark + 2]
        if following and following in "!?":
            closing = "-->" if page.startswith("<!--", mark) else ">"
            stop = page.find(closing, mark + (4 if closing == "-->" else 1))
            at = stop + len(closing) if stop >= 0 else end
            continue
        letter = page[mark + 2 : mark + 3] if following == "/" else following
        if not (letter.isalpha() and letter.isascii()):
            take("<")
            at = mark + 1
            continue
        if found := _TAG.match(page, mark):
            closing, tag, attributes = found.groups()
            at = found.end()
        else:  # a quote or a tag that never ends: the tag ends at the next bracket, or is the rest of the page
            stop = page.find(">", mark)
            if stop < 0:
                break
            closing, attributes, at = "/" if following == "/" else "", "", stop + 1
            tag = re.match(r"</?([^\s/>]*)", page[mark:stop]).group(1)
        tag = tag.lower()
        if tag == "br":
            take(" ")
        elif closing:
            end_tag(tag)
        else:
            before(tag)
            if tag in VOID:
                continue
            if tag in RAW:
                stop = None if tag in endless else re.compile(f"</{tag}[\\s/>]", re.IGNORECASE).search(page, at)
                if stop is not None:
                    close_at = page.find(">", stop.start())
                    at = close_at + 1 if close_at >= 0 else end
                elif tag in ("script", "style"):
                    break
                else:
                    endless[tag] = True
                continue
            stack.append(_element(tag, attributes, stack[-1]))
            elements.append(stack[-1])
            links += tag == "a"
    close(1)
    flush()
    return blocks, elements


def _block_score(block: Block) -> float:
    """The classifier on the text of a block."""
    words, within = block.text.count(" ") + 1, block.element.within
    score = (INSIDE if within else OUTSIDE) + PER_WORD * min(words, MOST_WORDS)
    if block.text[-1] in ".!?…:;\"”。！？" and words > 2:
        score += SENTENCE
    heading = block.element.tag in HEADING
    if block.linked and not (heading and within):
        score += (LINKS_INSIDE if within else LINKS) * block.linked / block.size
    if heading:
        score += TITLE
    if not within and words < 40 and CLAIMS.search(block.text):
        score += CLAIM
    return score


def _measure(blocks: list[Block], elements: list[Element]) -> None:
    """Counts what elements hold and scores the blocks; a word on the element around most of the page and an article is not believed."""
    for block in blocks:
        block.element.inside += 1
        block.element.size += block.size - block.linked
    for element in reversed(elements):
        if around := element.around:
            around.inside += element.inside
            around.size += element.size
            around.article |= element.article
    whole = elements[0].size
    for element in elements:
        if element.word and element.word not in COMMENTS and element.article and element.size > MOST * whole and element.tag not in ("article", *TAG_SCORE):
            element.score = 0.0
        if around := element.around:
            if around.bad < 0:  # what boilerplate holds is boilerplate, whatever it is called
                element.score = min(0.0, element.score)
            element.bad = element.score if element.score < 0 else around.bad
            element.within = element.bad == 0 and (element.score > 0 or around.within)
    for block in blocks:
        block.score = _block_score(block)


def _graph(blocks: list[Block]) -> tuple[list[int], list[list[tuple[int, int]]]]:
    """(score, edges) of nodes: blocks first, then elements; edges both ways as (node, capacity)."""
    number: dict[Element, int] = {}
    scores, edges = [], []

    def add(score: float) -> int:
        scores.append(round(score * SCALE))
        edges.append([])
        return len(scores) - 1

    def join(a: int, b: int, weight: float) -> None:
        capacity = round(weight * SCALE)
        if capacity > 0:
            edges[a].append((b, capacity))
            edges[b].append((a, capacity))

    for block in blocks:
        add(block.score)
    for k, block in enumerate(blocks):
        if k:
            join(k - 1, k, NEXT)
        below, held, element = k, 1, block.element
        while element is not None:
            known = element in number
            # Boilerplate marks hold for all that is inside, whatever its length.
            mark = element.score * element.inside if element.score < 0 else element.score
            node = number[element] if known else number.setdefault(element, add(mark))
            # An unmarked element around most of the page says little about what it holds.
            weight = AROUND if element.score else AROUND * (1 - element.inside / len(blocks))
            join(below, node, weight - element.bad * held)
            if known:
                break
            below, held, element = node, element.inside, element.around
    return scores, edges


def minimum_cut(scores: list[int], edges: list[list[tuple[int, int]]]) -> list[bool]:
    """Whether each node is on the content side of the least cut; of equal cuts the one with fewest nodes there.

    A node whose own score outweighs all its edges is on the side of its score in every least cut; its edges then count as scores of its
    neighbours. The rest is parted by augmenting shortest paths, level by level.
    """
    n, side = len(scores), [None] * len(scores)
    score, free = list(scores), [sum(c for _, c in e) for e in edges]
    todo = deque(range(n))
    while todo:
        k = todo.popleft()
        if side[k] is None and (abs(score[k]) > free[k] or not free[k]):
            side[k] = score[k] > 0
            for m, c in edges[k]:
                if side[m] is None:
                    score[m] += c if side[k] else -c
                    free[m] -= c
                    todo.append(m)
    rest = [k for k in range(n) if side[k] is None]
    if rest:
        place = {k: i for i, k in enumerate(rest)}
        reached = _max_flow([score[k] for k in rest], [[(place[m], c) for m, c in edges[k] if side[m] is None] for k in rest])
        for i, k in enumerate(rest):
            side[k] = reached[i]
    return side


def _max_flow(scores: list[int], edges: list[list[tuple[int, int]]]) -> list[bool]:
    """Nodes that the source still reaches after a maximum flow: the least source side."""
    n = len(scores)
    source, sink = n, n + 1
    head, room, out = [], [], [[] for _ in range(n + 2)]

    def arc(a: int, b: int, there: int, back: int) -> None:
        out[a].append(len(head))
        head.append(b)
        room.append(there)
        out[b].append(len(head))
        head.append(a)
        room.append(back)

    for k, s in enumerate(scores):
        if s > 0:
            arc(source, k, s, 0)
        elif s < 0:
            arc(k, sink, -s, 0)
        for m, c in edges[k]:
            if m > k:
                arc(k, m, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source], queue = 0, deque([source])
        while queue:
            k = queue.popleft()
            for e in out[k]:
                if room[e] and level[head[e]] < 0:
                    level[head[e]] = level[k] + 1
                    queue.append(head[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        upto, path, k = [0] * (n + 2), [], source
        while True:
            if k == sink:
                least = min(room[e] for e in path)
                for e in path:
                    room[e] -= least
                    room[e ^ 1] += least
                cut = next(i for i, e in enumerate(path) if not room[e])
                k = head[path[cut] ^ 1]
                del path[cut:]
                continue
            while upto[k] < len(out[k]):
                e = out[k][upto[k]]
                if room[e] and level[head[e]] == level[k] + 1:
                    break
                upto[k] += 1
            if upto[k] < len(out[k]):
                path.append(out[k][upto[k]])
                k = head[path[-1]]
            elif k == source:
                break
            else:
                level[k] = -1
                k = head[path.pop() ^ 1]


def extract(page: str | None) -> str:
    """The main text of one page."""
    blocks, elements = blocks_of(page or "")
    if not any(e.tag in BLOCK for e in elements):
        return "\n".join(b.text for b in blocks)
    _measure(blocks, elements)
    side = minimum_cut(*_graph(blocks))
    return "\n".join(b.text for b, content in zip(blocks, side) if content)


def main_text(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep`, text and n_chars (code points) of each page. One pass, nothing is shuffled."""
    fields = {f.name: f.dataType.simpleString() for f in pages.schema.fields}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(p) for p in batch.column(len(keep)).to_pylist()]
            columns = [*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "text", "n_chars"])

    schema = ", ".join([*(f"`{c}` {fields[c]}" for c in keep), "text string", "n_chars long"])
    return pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html_column}`").cast("string").alias("_html")).mapInArrow(read, schema)
