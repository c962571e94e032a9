"""Lines of text of an HTML page and where on the page they stand."""

from __future__ import annotations

import html
import re

#: Elements that end the line before them and after them.
BLOCKS = frozenset(
    "address article aside blockquote body br canvas caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section summary "
    "table tbody td tfoot th thead title tr ul".split()
)
#: Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup.
RAW = frozenset("script style noscript template textarea title iframe svg math select".split())
#: Elements that are never part of an article.
APART = frozenset("nav footer aside form button dialog menu head object audio video canvas label fieldset".split())
#: Words in a class, id or role that set an element apart.
APART_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo banner cookie cookies consent gdpr notice "
    "notices alert menu nav navigation navbar breadcrumb breadcrumbs sidebar footer masthead comment comments reply replies "
    "respond discussion disqus social share sharing related recommended newsletter subscribe signup popup modal overlay "
    "search login complementary contentinfo".split()
)
#: Elements often left open; without bearing on what surrounds them unless set apart.
LOOSE = frozenset("p b i u em strong small font".split())
MAIN = frozenset(("article", "main"))

_PART = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<",
    re.DOTALL,
)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RUN = re.compile(r"[A-Za-z]+")
_TOKEN = re.compile(r"[^\s\"']+")
#: Words beside which a name speaks of something else: ``has-sidebar`` is no sidebar.
NEUTRAL_NAMES = frozenset("has with no without not results".split())
#: Names of parts that stay apart even if they hold an article: readers' comments and adverts.
NEVER_MAIN = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo comment comments reply replies respond "
    "discussion disqus related recommended".split()
)
#: Start tags that end an element left open before them, by the open element's tag.
ENDED_BY = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option", "optgroup"},
}
#: What a head may hold; anything else begins the body.
IN_HEAD = frozenset("base link meta title script style noscript template".split())
#: Elements in which no article can stand; one that begins there shows that they were left open.
NO_ARTICLE_IN = frozenset("nav menu button label head".split())
#: Marked articles with less than this share of the text that is not set apart are teasers.
TEASER_SHARE = 0.2

#: Elements that hold running text: within a marked article their lines are the article's, quoted elsewhere or not.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th caption figcaption".split())

#: What may become of a line: it stays, it goes if it belongs to the site, or it stands beside a marked article.
STAYS, MAY_GO, OUTSIDE = range(3)

#: How an element is set apart: not at all, by its tag, by name or as a form, by a name that is never an article's.
_PLAIN, _BY_TAG, _BY_NAME, _NEVER = range(4)


def _kind(tag: str, attributes: str, inside: bool) -> int:
    if tag != "form" and (tag in APART or (tag == "header" and not inside)):
        return _BY_TAG
    kind = _BY_NAME if tag == "form" else _PLAIN
    if not attributes.strip() or tag in ("html", "body") or tag in MAIN:
        return kind
    for name, value in _NAMES.findall(attributes):
        if name.lower() == "hidden" or (name.lower() == "aria-hidden" and "true" in value.lower()):
            return _BY_TAG
        for token in _TOKEN.findall(value):
            words = {w.lower() for w in _RUN.findall(token) + _WORD.findall(token)}
            if NEUTRAL_NAMES.isdisjoint(words):
                if not NEVER_MAIN.isdisjoint(words):
                    return _NEVER
                if not APART_NAMES.isdisjoint(words):
                    kind = _BY_NAME
    return kind


class _Page:
    """The elements of a page in the order they begin, and its lines with the element each stands in."""

    def __init__(self, page: str):
        self.parent, self.kind, self.main, self.block = [-1], [_PLAIN], [False], [False]
        self.lines: list[tuple[str, int]] = []
        self.in_paragraph: list[bool] = []  # of each line; paragraphs are often left open and no elements here
        self._paragraph = False
        self._stack: list[tuple[str, int]] = []
        self._text: list[str] = []
        self._read(page)

    def _here(self) -> int:
        return self._stack[-1][1] if self._stack else 0

    def _end_line(self) -> None:
        if self._text:
            joined = " ".join(html.unescape("".join(self._text)).split())
            if joined:
                self.lines.append((joined, self._here()))
                self.in_paragraph.append(self._paragraph)
            self._text.clear()

    def _pop_to(self, depth: int) -> None:
        if any(self.kind[e] or self.main[e] for _, e in self._stack[depth:]):
            self._end_line()
        del self._stack[depth:]

    def _inside(self) -> bool:
        return any(self.main[e] for _, e in self._stack)

    def _end_what_is_over(self, tag: str) -> None:
        """Elements without an end tag that the start of ``tag`` ends."""
        tags = [open_ for open_, _ in self._stack]
        if "head" in tags and tag not in IN_HEAD:
            self._pop_to(tags.index("head"))
        if tag in MAIN and not self._inside():
            depth = next((i for i, (open_, _) in enumerate(self._stack) if open_ in NO_ARTICLE_IN), None)
            if depth is not None:
                self._pop_to(depth)
        if tag in BLOCKS and self._stack and self._stack[-1][0] == "p":
            self._pop_to(len(self._stack) - 1)
        while self._stack and tag in ENDED_BY.get(self._stack[-1][0], ()):
            self._pop_to(len(self._stack) - 1)

    def _read(self, page: str) -> None:
        at = 0
        while part := _PART.match(page, at):
            at = part.end()
            tag = part[2] or part[5]
            if tag is None:
                if not page.startswith(("<!", "<?"), part.start()):
                    if self._stack and self._stack[-1][0] == "head" and part[0].strip():
                        self._pop_to(len(self._stack) - 1)
                    self._text.append(part[0])
                continue
            tag, closing = tag.lower(), bool(part[1] or part[4])
            if not part[0].endswith(">"):
                break
            if tag in BLOCKS or tag in APART:
                self._end_line()
            if tag in BLOCKS and tag != "br":
                self._paragraph = tag == "p" and not closing
            if closing:
                for depth in range(len(self._stack) - 1, -1, -1):
                    if self._stack[depth][0] == tag:
                        self._pop_to(depth)
                        break
                continue
            attributes = part[3] or part[6] or ""
            self._end_what_is_over(tag)
            if tag in VOID or attributes.endswith("/"):
                continue
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
                at = close.end() if close else len(page)
                continue
            kind, main = _kind(tag, attributes, self._inside()), tag in MAIN
            if tag in LOOSE and not kind:
                continue
            if kind or main:
                self._end_line()
            self.parent.append(self._here())
            self.kind.append(kind)
            self.main.append(main)
            self.block.append(tag in TEXT_BLOCKS)
            self._stack.append((tag, len(self.kind) - 1))
        self._end_line()

    def _apart(self, freed: set[int]) -> list[bool]:
        apart = [False]
        for element in range(1, len(self.kind)):
            own = self.kind[element] != _PLAIN and element not in freed
            apart.append(own or apart[self.parent[element]])
        return apart

    def _around(self, element: int) -> list[int]:
        found = []
        while element:
            found.append(element)
            element = self.parent[element]
        return found

    def _freed(self) -> set[int]:
        """Parts set apart by name, or as forms, that hold what the page is about.

        They hold its article, if it has none elsewhere, or, if all lines are set apart, more than
        half of the text that may count at all.
        """
        apart = self._apart(set())
        mains = [e for e in range(len(self.main)) if self.main[e]]
        if mains and all(apart[e] for e in mains):
            around = [self._around(e) for e in mains]
            may = [ways for ways in around if all(self.kind[e] in (_PLAIN, _BY_NAME) for e in ways)]
            if may:
                return {e for ways in may for e in ways if self.kind[e] == _BY_NAME}
        if all(apart[e] for _, e in self.lines):
            held: dict[int, int] = {}
            total = 0
            for text, element in self.lines:
                ways = self._around(element)
                if all(self.kind[e] in (_PLAIN, _BY_NAME) for e in ways):
                    total += len(text)
                    for e in ways:
                        held[e] = held.get(e, 0) + len(text)
            return {e for e, size in held.items() if self.kind[e] == _BY_NAME and 2 * size > total}
        return set()

    def parts(self) -> tuple[list[str], list[int], bool]:
        apart = self._apart(self._freed())
        inside, text_block = [False], [False]
        for element in range(1, len(self.kind)):
            above = self.parent[element]
            inside.append(not apart[element] and (self.main[element] or inside[above]))
            text_block.append(inside[element] and (self.block[element] or text_block[above]))
        counted = [(text, e, p) for (text, e), p in zip(self.lines, self.in_paragraph) if not apart[e]]
        texts = [text for text, _, _ in counted]
        marked = [text for text, e, _ in counted if inside[e]]
        if sum(map(len, marked)) >= TEASER_SHARE * sum(map(len, texts)) and marked:
            return texts, [(STAYS if p or text_block[e] else MAY_GO) if inside[e] else OUTSIDE for _, e, p in counted], True
        return texts, [MAY_GO] * len(texts), False


def parts(page: str) -> tuple[list[str], list[int], bool]:
    """Lines that are not set apart, in page order; what may become of each; whether an article is marked.

    References are decoded, white space is one space. Comments, scripts and set-apart elements
    are left out with all they hold; a page cut off in a tag ends there. Elements may lack end tags
    where HTML allows that. A name or a form around the article, or around all there is, does not
    set it apart, and articles that hold little of the text are teasers beside an unmarked one.
    Lines of paragraphs, headings, lists, quotations and tables of a marked article stay.
    """
    return _Page(page).parts()


def lines(page: str) -> tuple[list[str], bool]:
    """Lines of the marked article in page order, or of all that is not set apart; whether one is marked."""
    texts, fates, marked = parts(page)
    return [text for text, fate in zip(texts, fates) if fate != OUTSIDE], marked
