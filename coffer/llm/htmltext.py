"""Main text of web pages by block rules in two passes."""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

# Common function words of four languages.
STOP_WORDS = frozenset(
    "a an and are as at be been but by for from had has have he her his i in is it its not of on or she that the their they this to "
    "was were which will with you "
    "aber als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich im in ist mit nach nicht "
    "oder sich sie sind so über um und von vor war wie wird zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas pour qui que sa se ses "
    "son sont sur un une vous à été "
    "al como con cual de del el ella en entre era es esta este fue ha la las lo los más me mi no o para pero por que se si sin su sus un "
    "una y ya así".split()
)

#: Elements whose content is never text. Those of RAW hold anything up to their end, and all the rest if that is missing;
#: the others are skipped up to their end if there is one.
RAW = frozenset(("script", "style", "noscript", "iframe", "textarea", "title"))
SILENT = RAW | frozenset(("template", "svg", "math", "object", "canvas", "audio", "video", "select", "button", "datalist"))
#: Of these, a slash before the bracket closes.
FOREIGN = frozenset(("svg", "math"))
#: Elements that hold navigation, forms and the like.
ASIDE = frozenset(("nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "header"))
MAIN = frozenset(("article", "main"))
#: Elements that hold blocks; they are followed until they are closed.
HOLDER = frozenset(("body", "html", "div", "section", "ul", "ol", "dl", "table", "thead", "tbody", "tfoot", "figure", "details", "blockquote", "center", "address")) | ASIDE | MAIN
#: Elements that are a block by themselves.
LEAF = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "td", "th", "tr", "pre", "hr", "caption", "figcaption", "summary", "legend", "option"))
#: Words in class, id or role of what is not the article; words are parted by hyphens, underscores and white space.
OTHER = re.compile(
    r"ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookie\w*|consent|notices?|alert|popup|modal|newsletter|subscri\w+|sidebar\w*"
    r"|side|widget\w*|menu\w*|nav|navbar|navigation|breadcrumb\w*|pagination|pager|footer\w*|header|masthead|comments?|commentlist|disqus\w*"
    r"|respond|responses|reply|replies|share|sharing|social|related|recommend\w*|login|signup|search\w*|toolbar|copyright|contentinfo"
    r"|complementary|dialog|form",
    re.I,
)
#: Names that begin with one of these tell about the page around: has-sidebar, with-comments.
ABOUT = frozenset(("has", "with", "no", "without", "is", "js", "not"))
NAMED = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?![^\s/>]))""", re.I)
#: A quote opens a value only after an equals sign. Nothing here is tried twice: matching takes linear time.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"""|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*+)(?P<rest>(?:[^>="']++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)>""",
    re.S,
)
#: The same with tags that end at the first bracket, for what follows a tag whose quotes run to the end of the page.
LOOSE = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*+)(?P<rest>[^>]*+)>", re.S)
OPENS = re.compile(r"</?[a-zA-Z]")
ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I) for tag in SILENT}

LONG, LINKS, DENSE, THIN, BARE = 70, 0.4, 0.25, 0.12, 0.03
#: A long block with next to no stop words.
THINLY = object()


def _apart(rest: str) -> bool:
    """Whether attributes name something that is not the article, or hide it."""
    for name, *values in NAMED.findall(rest):
        value = "".join(values)
        if name.lower() == "hidden" or (name.lower() == "aria-hidden" and value == "true"):
            return True
        for word in value.split():
            parts = re.split("[_-]+", word)
            if parts[0].lower() not in ABOUT and any(OTHER.fullmatch(part) for part in parts):
                return True
    return False


def _tokens(html: str):
    """Yields (text before, tag, whether it closes, attributes) in order, and at last the rest of the text with no tag."""
    pattern, at, said, last = TOKEN, 0, 0, html.rfind(">")
    endless: set[str] = set()
    while True:
        at = html.find("<", at)
        if at < 0:
            break
        m = pattern.match(html, at)
        if m is None:
            if pattern is TOKEN and at < last and OPENS.match(html, at):
                pattern = LOOSE
            elif at > last and OPENS.match(html, at):
                # No bracket follows, so nothing here is a tag.
                break
            else:
                at += 1
            continue
        tag = (m["tag"] or "").lower()
        yield html[said:at], tag, bool(m["close"]), m["rest"] or ""
        at = said = m.end()
        if tag in SILENT and not m["close"] and not (tag in FOREIGN and m["rest"].endswith("/")) and tag not in endless:
            end = ENDS[tag].search(html, at)
            if end:
                at = said = end.end()
            elif tag in RAW:
                at = said = len(html)
            else:
                endless.add(tag)
    yield html[said:], "", False, ""


class _Blocks:
    """Blocks of one page in order: [text, link characters, apart, inside article or main]."""

    def __init__(self, html: str):
        self.found, self.text, self.linked = [], [], 0
        # Of each open element: its name, whether it is apart, and whether it is in an article or main.
        self.open: list[tuple[str, bool, str]] = [("", False, "")]
        self.leaf_apart = self.in_link = False
        self.mains: set[str] = set()
        for text, tag, closes, rest in _tokens(html):
            self._say(text)
            if tag and tag not in SILENT:
                (self._end if closes else self._begin)(tag, rest)
        self._cut()
        # Where there is an article, it is the main part; else the main element is.
        inner = "article" if "article" in self.mains else "main"
        self.found = [(text, linked, apart, inner in main) for text, linked, apart, main in self.found]

    def _say(self, raw: str) -> None:
        if raw:
            text = unescape(raw) if "&" in raw else raw
            self.text.append(text)
            if self.in_link:
                self.linked += len("".join(text.split()))

    def _cut(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                _, apart, main = self.open[-1]
                self.found.append((text, self.linked, apart or self.leaf_apart, main))
        self.text, self.linked, self.leaf_apart = [], 0, False

    def _begin(self, tag: str, rest: str) -> None:
        if tag in HOLDER:
            self._cut()
            self.in_link = False
            _, apart, main = self.open[-1]
            # The heading of an article is part of it.
            aside = tag in ASIDE and not (tag == "header" and main)
            named = tag not in ("body", "html") and _apart(rest)
            if tag in MAIN and tag not in self.mains:
                # Whatever the elements around the first one are called, they hold it.
                self.mains.add(tag)
                apart = named = False
            self.open.append((tag, apart or aside or named, f"{main} {tag}" if tag in MAIN else main))
        elif tag in LEAF:
            self._cut()
            self.in_link = False
            self.leaf_apart = _apart(rest)
        elif tag == "br":
            self.text.append(" ")
        elif tag == "a":
            self.in_link = True

    def _end(self, tag: str, rest: str) -> None:
        if tag in HOLDER:
            self._cut()
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k][0] == tag:
                    del self.open[k:]
                    break
        elif tag in LEAF:
            self._cut()
        elif tag == "a":
            self.in_link = False


def main_blocks(html: str) -> list[str]:
    """The article's blocks.

    First pass: what is marked as navigation, advert and so on is bad. Long blocks with many stop words are good. On a
    page with an article (or else a main element) all else outside it is bad, and inside it long blocks with some stop
    words are good; elsewhere long blocks with next to no stop words are bad, and so are blocks that are mostly links. On a
    page where stop words show no good block, such as one in a language without any here, long blocks are good.
    Second pass: what is left (short blocks, middling ones) takes the label of the nearest decided block of its kind;
    between a good and a bad one at the same distance, and without decided blocks, it is good.
    """
    blocks = _Blocks(html).found
    has_main = any(main for _, _, _, main in blocks)
    labels: list = []
    for text, linked, apart, main in blocks:
        if apart or (has_main and not main) or (not main and linked > LINKS * max(1, len(text) - text.count(" "))):
            labels.append(False)
            continue
        words = text.lower().split()
        share = sum(w.strip(".,;:!?\"'()") in STOP_WORDS for w in words) / max(1, len(words))
        if len(text) < LONG:
            labels.append(None)
        elif share >= (THIN if main else DENSE):
            labels.append(True)
        else:
            labels.append(THINLY if not main and share < BARE else None)
    found = any(label is True for label in labels)
    labels = [(not found) if label is THINLY else label for label in labels]
    return [block[0] for block, label in zip(blocks, _decided(blocks, labels), strict=True) if label]


def _decided(blocks: list, labels: list[bool | None]) -> list[bool]:
    """Labels with the open ones taken from the nearest decided neighbour."""

    def nearest(order) -> dict[int, tuple[int, bool]]:
        last, out = None, {}
        for i in order:
            # What is marked as apart says nothing about the article around it.
            marked = blocks[i][2] or (any_main and not blocks[i][3])
            if labels[i] is not None and not marked:
                last = i
            out[i] = (abs(last - i), labels[last]) if last is not None else (len(labels) + 1, None)
        return out

    any_main = any(b[3] for b in blocks)
    left, right = nearest(range(len(labels))), nearest(range(len(labels) - 1, -1, -1))
    out = []
    for i, label in enumerate(labels):
        if label is None:
            (a, x), (b, y) = left[i], right[i]
            if x is None and y is None:
                label = True
            elif a == b:
                label = bool(x or y)
            else:
                label = bool(x if a < b else y)
        out.append(label)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and text, the main text of the whole html: blocks joined by an empty line.

    Character references are decoded and white space inside a block becomes one space; nothing else of a block is
    changed. Tags that never end are text. Time and memory grow with the length of the html. NULL, empty and text-free
    pages have an empty text; every row gives a row, repeated ones too. Other columns are left out.
    """

    def run(batches):
        for batch in batches:
            texts = ["\n\n".join(main_blocks(html)) if html else "" for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {kind}, url string, text string")
