"""One page of HTML read once with a stack of open elements (the row helper behind CV1).

Real pages are not well formed: end tags are optional or missing, attributes hold ``>`` in quotes, elements are left open. So a page
is cut into tags and text from left to right, an end tag closes everything above its element (or nothing, if none is
open), and a new block closes the paragraph before it. All of it is linear in the page.
"""

from __future__ import annotations

import html
import re

#: a tag (its attributes may hold '>' in quotes), else anything in '<...>' that starts like one, a comment or a declaration
_TOKEN = re.compile(r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_CLASS = re.compile(r"""\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_REFERENCE = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{0,31});")

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea template noscript iframe svg".split())
_DROPPED = frozenset("head title nav".split()) | _RAW
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BLOCKS = _HEADINGS | {"p", "li", "table"}
#: elements that end a paragraph where they begin and divide the text around them
_DIVIDING = frozenset("address article aside blockquote body details dd div dl dt fieldset figcaption figure footer form header hr html main "
                      "ol pre section summary ul".split())
_INSIDE_TABLE = frozenset("caption colgroup tbody td tfoot th thead tr".split())


def decode(text: str) -> str:
    """Character references that end in ';' decoded once, a no-break space to a blank; unknown and impossible ones stay."""
    def one(m: re.Match) -> str:
        name = m.group(1)
        if name[0] == "#":
            code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
            return chr(code) if 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else m.group()
        return " " if name == "nbsp" else html.entities.html5.get(f"{name};", m.group())

    return _REFERENCE.sub(one, text) if "&" in text else text


def _category(tag: str) -> str:
    return {"h1": "Title", "li": "List-item", "table": "Table"}.get(tag, "Section-header" if tag in _HEADINGS else "Text")


class _Reader:
    def __init__(self):
        self.open: list[str] = []  # open elements, without those that never have content
        self.count: dict[str, int] = {}
        self.blocks: list[tuple[int, str, str, bool]] = []  # (scope, category, raw text, from a block element)
        self.footers: list[list[str]] = []
        self.block: str | None = None  # the open block element
        self.text: list[str] = []
        self.cells = 0  # of the open table row
        self.dropped: int | None = None  # how deep the element lies whose content is left out
        self.footer: int | None = None

    def scope(self) -> int:
        return 2 if self.count.get("article") else 1 if self.count.get("main") else 0

    def flush(self, scope: int | None = None) -> None:
        text, self.text, tag, self.block, self.cells = "".join(self.text), [], self.block, None, 0
        if tag or text.strip():
            self.blocks.append((self.scope() if scope is None else scope, _category(tag or ""), text, tag is not None))

    def words(self, text: str) -> None:
        if self.dropped is None and text:
            (self.footers[-1] if self.footer is not None else self.text).append(text)

    def mark(self, sign: str) -> None:
        """A cell or row ends: its trailing blanks give way to the sign."""
        while self.text and not self.text[-1].strip():
            self.text.pop()
        if self.text:
            self.text[-1] = self.text[-1].rstrip()
        self.text.append(sign)

    def row(self) -> None:
        if self.cells:
            self.mark("\n")
        self.cells = 0

    def begin(self, tag: str, attributes: str) -> None:
        if self.dropped is None and self.footer is None:
            if self.block == "table":
                if tag == "table":
                    self.text.append(" ")
                elif tag == "tr":
                    self.row()
                elif tag in ("td", "th"):
                    if self.cells:
                        self.mark(" | ")
                    self.cells += 1
            elif tag in _BLOCKS:
                if not (tag == "p" and self.block == "li" and not "".join(self.text).strip()):  # the first paragraph of a list item
                    self.flush()
                    self.block = tag
            elif tag in _DIVIDING:
                if self.block != "li" or tag not in ("div", "section"):
                    self.flush()
        if tag in _VOID:
            return
        self.open.append(tag)
        self.count[tag] = self.count.get(tag, 0) + 1
        if self.dropped is None:
            named = _CLASS.search(attributes) if tag == "div" else None
            if tag in _DROPPED or named and "ad" in "".join(filter(None, named.groups())).lower().split():
                self.dropped = len(self.open)
            elif tag == "footer" and self.footer is None:
                self.footer = len(self.open)
                self.footers.append([])

    def end(self, tag: str) -> None:
        if not self.count.get(tag):
            return  # never opened
        if tag in _INSIDE_TABLE and "table" in self.open and self.open[::-1].index(tag) > self.open[::-1].index("table"):
            return  # of a table further out
        if self.dropped is None and self.footer is None:
            if self.block == "table":
                if tag == "tr":
                    self.row()
                elif tag == "table" and self.count["table"] == 1 or tag in ("article", "main", "body", "html"):
                    self.flush()
            elif tag == self.block or tag in _DIVIDING and not (self.block == "li" and tag in ("div", "section")):
                self.flush()
        while True:
            top = self.open.pop()
            self.count[top] -= 1
            if self.dropped is not None and len(self.open) < self.dropped:
                self.dropped = None
            if self.footer is not None and len(self.open) < self.footer:
                self.footer = None
            if top == tag:
                break

    def read(self, page: str) -> None:
        at = 0
        while True:
            m = _TOKEN.search(page, at)
            if m is None:
                break
            self.words(page[at:m.start()])
            at = m.end()
            closing, name, attributes = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
            if not name:
                continue
            tag = name.lower()
            if closing:
                self.end(tag)
                continue
            self.begin(tag, attributes)
            if tag in _RAW and not attributes.endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}[\s>/]", re.I).search(page, at)
                at = close.start() if close else len(page)
        self.words(page[at:])
        self.flush()


def page_blocks(page: str | None) -> list[tuple[str, str]]:
    """Ordered (category, text) of a page; see ``pages.pages_to_blocks``."""
    if page is None:
        return []
    reader = _Reader()
    reader.read(page)
    best = max((s for s, _, text, _ in reader.blocks if text.strip()), default=0)
    out = []
    for scope, category, text, _ in reader.blocks:
        if scope >= best:
            out.append((category, decode(text.strip(" \n\r\t\f"))))
    footer = " ".join("".join(f).strip(" \n\r\t\f") for f in reader.footers if "".join(f).strip())
    return [*out, ("Page-footer", decode(footer))] if footer else out
