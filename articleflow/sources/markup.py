"""A small HTML reader: one pass over the tags with a stack of open elements,
and CSS-like selectors matched against that stack.

It is the per-row helper of page extraction (pages.py).  Selectors: ``tag``,
``*``, ``#id``, ``.class``, ``[attr]``, ``[attr=value]`` and the ``~= |= ^= $=
*=`` forms, any of them combined; descendants (blank) and children (``>``);
lists (``,``).  Other forms raise ValueError.

Reading is forgiving: an end tag closes the elements inside its own element, an
unmatched one is ignored, paragraphs, list items and table cells end where the
next one starts, and whatever is open at the end is closed there.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

#: Fixed values of HTML: elements without content, elements whose content is no
#: markup, and what ends an open element of the same kind.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "template", "noscript", "iframe", "xmp"}
UNSEEN = {"script", "style", "template"}
ENDS_PARAGRAPH = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
                  "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"}, "tr": {"tr", "tbody", "tfoot"},
            "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "p": ENDS_PARAGRAPH}
#: Elements that keep an end rule from reaching further out.
SCOPE = {"table", "ul", "ol", "dl", "select", "button", "body", "html"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"'=]++|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"([A-Za-z][A-Za-z0-9_-]*|\*)|#([\w-]+)|\.([\w-]+)|\[\s*([\w:.-]+)\s*(?:([~|^$*]?=)\s*(?:\"([^\"]*)\"|'([^']*)'|([^\]\s]+))\s*)?\]")


def attributes(text: str) -> dict[str, str]:
    """Attributes of a tag, the first of each name, entities decoded."""
    out: dict[str, str] = {}
    for name, *value in _ATTR.findall(text):
        out.setdefault(name.lower(), html.unescape("".join(value)))
    return out


def _test(attr: str, op: str, value: str):
    def holds(attrs: dict[str, str]) -> bool:
        own = attrs.get(attr)
        if own is None or not op:
            return own is not None
        return {"=": own == value, "~=": value in own.split(), "|=": own == value or own.startswith(value + "-"),
                "^=": bool(value) and own.startswith(value), "$=": bool(value) and own.endswith(value), "*=": bool(value) and value in own}[op]
    return holds


@lru_cache(maxsize=4096)
def compiled(selector: str) -> tuple:
    """A selector as alternatives; each is a list, last element first, of (tag or
    None, tests of the attributes, whether the next one out must be the parent)."""
    out = []
    for alternative in re.split(r",(?![^\[]*\])", selector):
        steps, at, child, alternative = [], 0, False, alternative.strip()
        while at < len(alternative):
            gap = re.compile(r"\s*>\s*|\s+").match(alternative, at)
            if gap:
                if not steps:
                    raise ValueError(f"unsupported selector: {selector!r}")
                child, at = ">" in gap.group(), gap.end()
            tag, tests, begin = None, [], at
            while m := _PART.match(alternative, at):
                name, ident, cls, attr, op, *value = m.groups()
                if name and at > begin:
                    break
                if name:
                    tag = None if name == "*" else name.lower()
                elif ident:
                    tests.append(_test("id", "=", ident))
                elif cls:
                    tests.append(_test("class", "~=", cls))
                else:
                    tests.append(_test(attr.lower(), op or "", "".join(v or "" for v in value)))
                at = m.end()
            if at == begin:
                raise ValueError(f"unsupported selector: {selector!r}")
            steps.append((tag, tuple(tests), child))
            child = False
        if not steps:
            raise ValueError(f"unsupported selector: {selector!r}")
        # the flag of a step says how it hangs on the step before it
        out.append(tuple(steps[::-1]))
    return tuple(out)


def matches(selector: tuple, stack: list) -> bool:
    """Whether the innermost of the open elements (tag, attributes) matches."""
    def fits(step, element) -> bool:
        return step[0] in (None, element[0]) and all(t(element[1]) for t in step[1])

    def outward(steps: tuple, at: int) -> bool:
        if not fits(steps[0], stack[at]):
            return False
        if len(steps) == 1:
            return True
        if steps[0][2]:
            return at > 0 and outward(steps[1:], at - 1)
        return any(outward(steps[1:], k) for k in range(at - 1, -1, -1))
    return any(outward(steps, len(stack) - 1) for steps in selector)


class Wanted:
    """The selectors of one extraction: what to remove, and the lists to pick from."""

    def __init__(self, remove: tuple, lists: tuple):
        self.remove, self.lists = [compiled(s) for s in remove], [[compiled(s) for s in x] for x in lists]
        every = [a[0] for s in [*self.remove, *sum(self.lists, [])] for a in s]
        #: Tags that some selector may end in (None: any).
        self.tags = None if any(tag is None for tag, _, _ in every) else {tag for tag, _, _ in every}
        #: Whether any selector looks at the attributes of outer elements.
        self.outer = any(step[1] for s in [*self.remove, *sum(self.lists, [])] for a in s for step in a[1:])


@lru_cache(maxsize=1024)
def wanted(remove: tuple, lists: tuple) -> Wanted:
    return Wanted(remove, lists)


def extract(page: str, want: Wanted) -> list[str | None]:
    """For each list of selectors, the text of the first selector's first
    element that has any (``meta`` gives its content); None where none has.
    Text nodes are decoded and stripped, empty ones left out, the others joined
    with a blank.  Removed elements are not there."""
    stack: list[tuple] = []                 # (tag, attributes)
    first = [[None] * len(x) for x in want.lists]       # texts of each selector's first element
    held: list[tuple[int, list]] = []       # (depth, texts) of those that are open
    gone = 0                                # depth of the removed element, 0 if none

    def text(raw: str) -> None:
        if held and not gone and (not stack or stack[-1][0] not in UNSEEN):
            node = html.unescape(raw).strip()
            if node:
                for _, texts in held:
                    texts.append(node)

    def close(depth: int) -> None:
        nonlocal gone
        del stack[depth:]
        while held and held[-1][0] > depth:
            held.pop()
        if gone > depth:
            gone = 0

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            break
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        slash, tag, rest = m.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        for k in range(len(stack) - 1, -1, -1):
            if tag in ENDED_BY.get(stack[k][0], ()):
                close(k)
            elif stack[k][0] in SCOPE:
                break
        may = want.tags is None or tag in want.tags
        stack.append((tag, attributes(rest) if may or want.outer else {}))
        if not gone and may:
            if any(matches(s, stack) for s in want.remove):
                gone = len(stack)
            else:
                for own, selectors in zip(first, want.lists):
                    for k, s in enumerate(selectors):
                        if own[k] is None and matches(s, stack):
                            own[k] = texts = []
                            if tag == "meta":
                                texts.append(stack[-1][1].get("content", "").strip())
                            else:
                                held.append((len(stack), texts))
        if tag in VOID or rest.endswith("/") and tag not in RAW and tag in {"svg", "path"}:
            close(len(stack) - 1)
        elif tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            text(page[at:stop.start() if stop else end])
            at = stop.end() if stop else end
            close(len(stack) - 1)
    if at < end:
        text(page[at:])
    return [next((joined for texts in own if texts and (joined := " ".join(t for t in texts if t))), None) for own in first]
