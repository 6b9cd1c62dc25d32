"""Leaf blocks of an HTML page: runs of text between block-level tags, with what encloses them."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
MARK = re.compile(r"\bdata-main\b")
WORD = re.compile(r"[a-z0-9]+")
#: Elements whose content is no text of the page.
HIDDEN = frozenset("script style template noscript title svg iframe object textarea select datalist".split())
#: Of these, the ones whose content is characters only: no tag or comment begins in it, it runs up to its own end tag.
RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in "script style title iframe textarea".split()}
#: What changes the state of a script: in a comment of its own, a script start tag hides the next end tag.
SCRIPT = re.compile(r"<!(?=--)|-->|<(/?)script(?=[\s/>])", re.I)
#: Elements that do not end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key ends an open element of these names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table body html div article section main nav aside header footer form".split())


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]
    names: tuple[str, ...]
    link_chars: int
    marked: bool


@dataclass
class Open:
    tag: str
    names: tuple[str, ...] = ()
    marked: bool = False


@dataclass
class Page:
    stack: list[Open] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    run: list[str] = field(default_factory=list)
    link_chars: int = 0
    where: tuple[Open, ...] = ()

    def flush(self) -> None:
        text = " ".join("".join(self.run).split())
        if text:
            names = tuple(dict.fromkeys(n for o in self.where for n in o.names))
            tags = tuple(o.tag for o in self.where)
            self.blocks.append(Block(text, tags, names, self.link_chars, any(o.marked for o in self.where)))
        self.run, self.link_chars = [], 0

    def close(self, names: set[str], within: frozenset[str] = frozenset()) -> None:
        """Close the innermost open element of these names, and all inside it."""
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag in names:
                del self.stack[at:]
                return
            if self.stack[at].tag in within:
                return


def end_of_script(html: str, at: int) -> int:
    """Where the end tag of a script begins whose content begins at `at`, by the states of the HTML standard."""
    escaped = 0
    for m in SCRIPT.finditer(html, at):
        if m[1] is None:
            escaped = 0 if m[0] == "-->" else max(escaped, 1)
        elif not m[1]:
            escaped = 2 if escaped else 0
        elif escaped < 2:
            return m.start()
        else:
            escaped = 1
    return len(html)


def after_raw(html: str, tag: str, at: int) -> int:
    """The place behind the end tag of a raw element whose content begins at `at`."""
    if tag == "script":
        start = end_of_script(html, at)
    else:
        found = RAW[tag].search(html, at)
        start = found.start() if found else len(html)
    return html.find(">", start) + 1 or len(html)


def blocks_of(html: str) -> list[Block]:
    """The page's blocks in order. White space inside a block is one space; character references are decoded.

    A head needs no end tag: all that may stand in it is hidden by itself, so the tag only ends a block.
    """
    page = Page()
    hidden = ""
    depth = at = 0
    while at < len(html):
        token = TOKEN.match(html, at)
        at = token.end()
        tag = (token[2] or "").lower()
        opens = bool(tag) and not token[1] and not token[3].rstrip().endswith("/")
        if opens and tag in RAW:
            if not hidden:
                page.flush()
            at = after_raw(html, tag, at)
            continue
        if hidden:
            # These may hold elements of the same name.
            if tag == hidden:
                depth += opens - bool(token[1])
                if depth <= 0:
                    hidden = ""
            continue
        if not tag:
            text = token[0]
            if text.startswith(("<!", "<?")) and len(text) > 1:
                continue
            text = entities.unescape(text)
            if not page.run and text.strip():
                page.where = tuple(page.stack)
            if page.run or text.strip():
                page.run.append(text)
                if any(o.tag == "a" for o in page.stack):
                    page.link_chars += len(text.strip())
            continue
        if tag in HIDDEN:
            if not token[1]:
                page.flush()
            if opens:
                hidden, depth = tag, 1
            continue
        if tag not in INLINE:
            page.flush()
        if tag == "head":
            continue
        if token[1]:
            page.close({tag})
            continue
        if tag in CLOSES:
            page.close(CLOSES[tag], SCOPES)
        elif tag not in INLINE and tag not in VOID:
            page.close({"p"}, SCOPES)
        if tag not in VOID and opens:
            names = tuple(WORD.findall(" ".join("".join(m) for m in NAMES.findall(token[3])).lower()))
            page.stack.append(Open(tag, names, bool(MARK.search(token[3]))))
    page.flush()
    return page.blocks
