"""Leaf blocks of HTML: text between block borders, with the path of open elements."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Fixed values of HTML: elements that cannot have content, whose content is no text, that break lines.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style iframe".split())
#: Elements that hold others and show no text of their own, up to their end tag; and one that is a block within any other.
HIDDEN = frozenset("template svg".split())
SET_APART = "noscript"
BLOCK = frozenset(
    "html head body title address article aside blockquote button canvas caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr label legend li main menu nav ol option p pre section"
    " select summary table tbody td textarea tfoot th thead tr ul br".split()
)
#: Elements that end an open one of the same kind when they begin.
CLOSES_ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME_PART = re.compile(r"[a-z]+")
#: A last attribute value without quotes, which keeps a slash at its end.
UNQUOTED = re.compile(r"=\s*[^\s\"']+$")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int


def named(attributes: str) -> list[str]:
    """The letters-only parts of class, id and role."""
    if not attributes:
        return []
    return NAME_PART.findall(" ".join(a or b or c for a, b, c in NAMED.findall(attributes)).lower())


def _drawn_whole(tag: str, attributes: str) -> bool:
    """Whether a start tag closes itself. Outside drawings HTML passes over such a slash."""
    return tag == "svg" and attributes.endswith("/") and not UNQUOTED.search(attributes)


def _raw_end(page: str, tag: str, at: int) -> int:
    """Where a raw element ends whose start tag ends at ``at``: behind its end tag, or with the page."""
    end = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
    return end.end() if end else len(page)


def hidden_ends(page: str, at: int) -> dict[int, int]:
    """From ``at`` on, for each hidden element that has an end tag of its own: the ends of its start tag and of its end tag."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {tag: [] for tag in HIDDEN}
    while m := TOKEN.search(page, at):
        at = m.end()
        tag = (m.group(2) or "").lower()
        if tag in HIDDEN:
            if not m.group(1):
                if not _drawn_whole(tag, m.group(3)):
                    opened[tag].append(at)
            elif opened[tag]:
                ends[opened[tag].pop()] = at
        elif tag in RAW and not m.group(1):
            at = _raw_end(page, tag, at)
    return ends


def blocks(page: str | None) -> list[Block]:
    """Blocks with text in page order; references decoded, white space in a block made one space, trimmed.

    Comments, scripts, styles, frames, templates and drawings are no text. Missing end tags are supplied, stray
    ones passed over, a page that ends early ends all that is open. A template or drawing without an end tag
    hides nothing. What a page shows without scripts is a block like others.
    """
    page = page or ""
    found: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    path: tuple[str, ...] = ()
    pending: list[str] = []
    linked = 0
    inside: tuple[str, ...] = ()
    hidden: dict[int, int] | None = None

    def flush() -> None:
        nonlocal linked
        if pending:
            text = " ".join("".join(pending).split())
            if text:
                found.append(Block(inside, text, linked))
            pending.clear()
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked, inside
        text = html.unescape(raw) if "&" in raw else raw
        if not pending or not inside:
            inside = path
        if text.strip():
            if not any(p.strip() for p in pending):
                inside = path
            if "a" in path[-4:]:
                linked += len(text.split())
        pending.append(text)

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in BLOCK or tag == SET_APART:
            flush()
        if m.group(1):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    path = stack[-1][1] if stack else ()
                    break
            continue
        if tag in RAW:
            at = _raw_end(page, tag, at)
            continue
        if tag in HIDDEN:
            if _drawn_whole(tag, m.group(3)):
                continue
            if hidden is None:
                hidden = hidden_ends(page, m.start())
            at = hidden.get(at, at)
            continue
        if tag in VOID:
            continue
        ends = (tag,) if tag in CLOSES_ITSELF else ("p",) if tag in BLOCK else ()
        limits = CLOSES_ITSELF.get(tag, ())
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in ends:
                del stack[i:]
                break
            if stack[i][0] in limits or (not limits and stack[i][0] in ("table", "button")):
                break
        path = (*(stack[-1][1] if stack else ()), tag, *("." + n for n in named(m.group(3))))
        stack.append((tag, path))
    flush()
    return found
