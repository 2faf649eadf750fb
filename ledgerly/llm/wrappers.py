"""Union-free wrappers of web pages: the regular expression behind a host's pages.

A page is a stream of tags and texts. Read level by level, an element is its
start tag, the stream inside it and its end tag. A wrapper describes the streams
of many pages by one expression without alternatives: elements, text slots,
optional parts ``( )?`` and repeated parts ``( )+``.

Two streams are aligned on their tags. Where they agree, the insides are aligned
in turn; a part that only one of them has becomes optional; neighbours of equal
shape become one repeated part, single elements as well as runs of up to
``MOST_PERIOD`` elements. A stream that stays longer than ``MOST_PARTS`` is
described as a repeated run of its distinct parts, each optional.

Everything here is plain Python over one page or two wrappers.
"""

from __future__ import annotations

import json
import re
import zlib
from html import unescape

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAK = frozenset(("br", "hr"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s "
    "samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements whose start closes an open element of the same group, and the
#: containers that the search for one does not leave.
CLOSES = {t: (frozenset(group.split()), frozenset(stop.split())) for group, stop in (
    ("li", "ul ol menu section article table nav"), ("dt dd", "dl section article table nav"),
    ("tr", "table"), ("td th", "tr table"), ("option optgroup", "select datalist"),
    ("thead tbody tfoot", "table")) for t in group.split()}

MOST_PERIOD, MOST_PARTS = 4, 64
#: Streams with a larger product of lengths are aligned greedily.
MOST_CELLS = 1 << 16
#: Elements nested deeper that carry no mark of their own count to the level above.
MOST_DEPTH = 100
#: Shapes and alignments that a worker remembers.
MOST_SHAPES, MOST_PATHS = 1 << 17, 1 << 19

_ATTRS = r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)"""
_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<(script|style|title|textarea|xmp|iframe|noembed|noframes|noscript)(?=[\s/>])" + _ATTRS
    + r">.*?(?:</\1(?=[\s/>])[^>]*(?:>|\Z)|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)" + _ATTRS + r"(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)"
    r"|([^<]+|<)", re.S | re.I)
_MARKED = re.compile(r"\b(?:class|id|role|itemprop)\s*=", re.I)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SIGN = {"class": ".", "id": "#", "role": "@", "itemprop": "*"}

TEXT, RUN, ANY = "#text", "(run)", "(any)"


def _names(value: str) -> list[str]:
    """Words of an attribute: numbers at the end go, made-up names (a digit
    before a letter) are left out, so that they do not tell pages apart."""
    out = []
    for name in unescape(value).lower().replace("/", "-").split():
        name = re.sub(r"[-_]?\d+$", "", name)
        if name and not re.search(r"\d", name):
            out.append(name)
    return out


def element_key(tag: str, attrs: str) -> str:
    """``tag.class#id@role*itemprop``: what elements are aligned by."""
    key = tag.replace("/", "-")
    if _MARKED.search(attrs):
        found: dict[str, str] = {}
        for name, *values in _ATTR.findall(attrs):
            found.setdefault(name.lower(), next((v for v in values if v), ""))
        for name, sign in _SIGN.items():
            key += "".join(sign + n for n in _names(found.get(name, "")))
    return key


class Shapes:
    """Streams of parts, each stored once. A part is ``(key, mark, inside)``:
    mark is ``""``, ``?``, ``+`` or ``*``, inside the number of a stream."""

    def __init__(self):
        self.parts: list[tuple] = [()]
        self.number: dict[tuple, int] = {(): 0}
        self.folded: dict[tuple, int] = {}
        self.merged: dict[tuple[int, int], int] = {}

    def full(self) -> bool:
        return max(len(self.parts), len(self.folded), len(self.merged)) > MOST_SHAPES

    def of(self, parts: tuple) -> int:
        n = self.number.get(parts)
        if n is None:
            n = self.number[parts] = len(self.parts)
            self.parts.append(parts)
        return n

    # -- repeated parts
    def fold(self, parts: list[tuple]) -> int:
        """The stream with its repeats folded."""
        raw = tuple(parts)
        known = self.folded.get(raw)
        if known is None:
            known = self.folded[raw] = self._fold(list(raw))
        return known

    def _fold(self, parts: list[tuple]) -> int:
        if len(parts) == 1 and parts[0][0] == ANY or not parts:
            return self.of(tuple(parts))
        if any(p[0] == ANY for p in parts):
            return self._any(parts)
        period = 1
        while period <= MOST_PERIOD:
            folded = self._fold_period(parts, period)
            period = period + 1 if folded is None else 1
            parts = folded or parts
        return self.of(tuple(parts)) if len(parts) <= MOST_PARTS else self._any(parts)

    def _fold_period(self, parts: list[tuple], period: int) -> list[tuple] | None:
        """One pass over runs of ``period`` parts; None if nothing repeats."""
        out: list[tuple] = []
        changed, i = False, 0
        while i < len(parts):
            run = parts[i:i + period]
            if len(run) == period:
                if period == 1:
                    last = [out[-1]] if out and out[-1][0] == run[0][0] else None
                elif out and out[-1][0] == RUN and self._keys(out[-1][2]) == [p[0] for p in run]:
                    last = out[-1:]
                else:
                    last = out[-period:] if len(out) >= period and (
                        [p[0] for p in out[-period:]] == [p[0] for p in run]) else None
                if last is not None:
                    changed = True
                    del out[len(out) - len(last):]
                    out.append(self._repeated(last, run, period))
                    i += period
                    continue
            out.append(parts[i])
            i += 1
        return out if changed else None

    def _keys(self, number: int) -> list[str]:
        return [p[0] for p in self.parts[number]]

    def _repeated(self, before: list[tuple], run: list[tuple], period: int) -> tuple:
        if period == 1:
            (key, mark, inside), (_, more, other) = before[0], run[0]
            return (key, "*" if mark in "?*" and mark and more in "?*" and more else "+",
                    self.merge(inside, other))
        inside = before[0][2] if len(before) == 1 else self.of(tuple(before))
        return (RUN, "+", self.merge(inside, self.of(tuple(run))))

    def _any(self, parts: list[tuple]) -> int:
        """A repeated run of the distinct parts, each optional."""
        found: dict[str, tuple] = {}
        queue = list(parts)
        while queue:
            key, mark, inside = queue.pop(0)
            if key in (RUN, ANY):
                queue = list(self.parts[inside]) + queue
            elif key in found:
                found[key] = (key, "*" if "+" in found[key][1] + mark or "*" in found[key][1] + mark
                              else "?", self.merge(found[key][2], inside))
            else:
                found[key] = (key, "*" if mark in ("+", "*") else "?", inside)
        inside = self.of(tuple(found[k] for k in sorted(found)))
        return self.of(((ANY, "*", inside),))

    # -- alignment
    def merge(self, a: int, b: int) -> int:
        """The stream that describes both."""
        if a == b:
            return a
        key = (a, b) if a < b else (b, a)
        known = self.merged.get(key)
        if known is None:
            known = self.merged[key] = self._merge(self.parts[key[0]], self.parts[key[1]])
        return known

    def _merge(self, a: tuple, b: tuple) -> int:
        if any(p[0] == ANY for p in a + b):
            return self._any([*a, *b])
        out: list[tuple] = []
        i = j = 0
        for x, y in [*_common([p[0] for p in a], [p[0] for p in b]), (len(a), len(b))]:
            out += [_optional(p) for p in (*a[i:x], *b[j:y])]
            if x < len(a):
                (key, mark, inside), (_, more, other) = a[x], b[y]
                out.append((key, _mark(mark + more), self.merge(inside, other)))
            i, j = x + 1, y + 1
        return self.fold(out)

    # -- text forms
    def to_lists(self, number: int) -> list:
        return [[key, mark, self.to_lists(inside)] for key, mark, inside in self.parts[number]]

    def from_lists(self, lists: list) -> int:
        return self.of(tuple((key, mark, self.from_lists(inside)) for key, mark, inside in lists))

    def expression(self, number: int) -> str:
        out = []
        for key, mark, inside in self.parts[number]:
            within = self.expression(inside)
            if key == TEXT:
                out.append("TEXT" + mark)
            elif key in (RUN, ANY):
                out.append(f"({within}){mark}")
            else:
                item = f"<{key}>{within}</{key}>"
                out.append(f"({item}){mark}" if mark else item)
        return "".join(out)

    def repeated_paths(self, number: int, at: str = "", inside_repeat: bool = False) -> set[str]:
        """Paths of the text slots that lie in a repeated part."""
        out: set[str] = set()
        for key, mark, inside in self.parts[number]:
            repeat = inside_repeat or mark in ("+", "*") and key != TEXT
            if key == TEXT:
                if repeat:
                    out.add(at)
            else:
                out |= self.repeated_paths(inside, at if key in (RUN, ANY) else f"{at}/{key}", repeat)
        return out


def _optional(part: tuple) -> tuple:
    return (part[0], {"": "?", "+": "*"}.get(part[1], part[1]), part[2])


def _mark(marks: str) -> str:
    optional, repeated = "?" in marks or "*" in marks, "+" in marks or "*" in marks
    return "*" if optional and repeated else "?" if optional else "+" if repeated else ""


def _common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a common subsequence: a longest one, or for very long streams
    one that takes each part's next occurrence."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    x, y = a[start:len(a) - end], b[start:len(b) - end]
    middle: list[tuple[int, int]] = []
    if len(x) * len(y) <= MOST_CELLS:
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(len(x) - 1, -1, -1):
            for j in range(len(y) - 1, -1, -1):
                best[i][j] = (best[i + 1][j + 1] + 1 if x[i] == y[j]
                              else max(best[i + 1][j], best[i][j + 1]))
        i = j = 0
        while i < len(x) and j < len(y):
            if x[i] == y[j]:
                middle.append((i, j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    else:
        places: dict[str, list[int]] = {}
        for j in range(len(y) - 1, -1, -1):
            places.setdefault(y[j], []).append(j)
        at = -1
        for i, key in enumerate(x):
            later = places.get(key, [])
            while later and later[-1] <= at:
                later.pop()
            if later:
                at = later.pop()
                middle.append((i, at))
    return ([(i, i) for i in range(start)] + [(i + start, j + start) for i, j in middle]
            + [(len(a) - k, len(b) - k) for k in range(end, 0, -1)])


class Reader:
    """Reads pages into streams. Paths of elements are numbered per worker."""

    def __init__(self):
        self.shapes = Shapes()
        self.paths: list[str] = [""]
        self.numbers: dict[tuple[int, str], int] = {}

    def renew(self) -> None:
        """Forget, if a bound is passed, what was learnt from earlier pages."""
        if self.shapes.full():
            self.shapes = Shapes()
        if len(self.paths) > MOST_PATHS:
            self.paths, self.numbers = [""], {}

    def path(self, parent: int, key: str) -> int:
        n = self.numbers.get((parent, key))
        if n is None:
            n = self.numbers[(parent, key)] = len(self.paths)
            self.paths.append(f"{self.paths[parent]}/{key}")
        return n

    def read(self, html: str) -> tuple[list[tuple[int, str, bool] | None], int]:
        """The page's texts as (path, text, inside a link), None where a block
        starts or ends, and the number of its stream."""
        texts: list[tuple[int, str, bool] | None] = []
        parts: list[tuple] = []                 # of the innermost element
        # open elements: tag, key ("" if it is no level of its own), path of the
        # level around it, parts of the level around it
        stack: list[tuple[str, str, int, list]] = []
        opened: dict[str, int] = {}
        path = depth = 0
        add, fold, shapes_path = texts.append, self.shapes.fold, self.path

        def close() -> None:
            nonlocal parts, path, depth
            tag, key, outer_path, outer = stack.pop()
            opened[tag] -= 1
            if key:
                part = (key, "", fold(parts))
                parts, path, depth = outer, outer_path, depth - 1
                _put(parts, part)
            if tag not in INLINE:
                add(None)

        for raw, _, slash, tag, attrs, text in _TOKEN.findall(html):
            if text:
                if not text.isspace():
                    _put(parts, (TEXT, "", 0))
                add((path, text, opened.get("a", 0) > 0))
                continue
            if raw or not tag:
                continue
            tag = tag.lower()
            inline = tag in INLINE
            if slash:
                if opened.get(tag, 0):
                    if inline and not any(tag == e[0] for e in _inline_top(stack)):
                        continue                    # a block was opened in between
                    while stack[-1][0] != tag:
                        close()
                    close()
                elif not inline:
                    add(None)
                continue
            if tag in VOID:
                if tag in BREAK:
                    add(None)
                continue
            if not inline:
                if opened.get("p", 0):
                    while any(e[0] == "p" for e in stack) and opened["p"]:
                        if stack[-1][0] not in INLINE and stack[-1][0] != "p":
                            break
                        close()
                if tag in CLOSES:
                    same, stop = CLOSES[tag]
                    if any(opened.get(t, 0) for t in same):
                        at = len(stack) - 1
                        while at >= 0 and stack[at][0] not in same and stack[at][0] not in stop:
                            at -= 1
                        if at >= 0 and stack[at][0] in same:
                            while len(stack) > at:
                                close()
                add(None)
            key = element_key(tag, attrs)
            if (inline or depth >= MOST_DEPTH) and key == tag and tag not in ("article", "main", "nav",
                                                                            "aside", "footer", "form"):
                key = ""
            stack.append((tag, key, path, parts))
            opened[tag] = opened.get(tag, 0) + 1
            if key:
                path, parts, depth = shapes_path(path, key), [], depth + 1
        while stack:
            close()
        return texts, fold(parts)


def _put(parts: list[tuple], part: tuple) -> None:
    """Append a part; a neighbour that is wholly equal is repeated at once."""
    if parts and parts[-1][0] == part[0] and parts[-1][2] == part[2]:
        if not parts[-1][1]:
            parts[-1] = (part[0], "+", part[2])
    else:
        parts.append(part)


def _inline_top(stack: list[tuple]):
    """Open inline elements from the innermost to the nearest block."""
    for entry in reversed(stack):
        if entry[0] not in INLINE:
            return
        yield entry


class Wrapper:
    """A host's expression, its text slots and its number of pages. A slot is
    ``path: [pages, characters, characters in links, digest]``; the digest is
    that of the slot's text while it has been the same on every page, then -1."""

    def __init__(self, shape: int = 0, slots: dict[str, list[int]] | None = None, pages: int = 0):
        self.shape, self.slots, self.pages = shape, slots or {}, pages

    def add_page(self, reader: Reader, html: str) -> None:
        texts, shape = reader.read(html)
        self.shape = reader.shapes.merge(self.shape, shape) if self.pages else shape
        self.pages += 1
        here: dict[int, list] = {}
        for item in texts:
            if item is not None and not item[1].isspace():
                path, text, link = item
                text = text.strip()
                slot = here.setdefault(path, [0, 0, 0])
                slot[0] += len(text)
                slot[1] += len(text) if link else 0
                slot[2] = zlib.crc32(text.encode("utf-8", "surrogatepass"), slot[2])
        for path, (size, links, digest) in here.items():
            self._add_slot(reader.paths[path], 1, size, links, digest)

    def _add_slot(self, path: str, pages: int, size: int, links: int, digest: int) -> None:
        slot = self.slots.get(path)
        if slot is None:
            self.slots[path] = [pages, size, links, digest]
        else:
            slot[0] += pages
            slot[1] += size
            slot[2] += links
            if slot[3] != digest:
                slot[3] = -1

    def add(self, other: Wrapper, shapes: Shapes) -> None:
        self.shape = shapes.merge(self.shape, other.shape) if self.pages else other.shape
        self.pages += other.pages
        for path, slot in other.slots.items():
            self._add_slot(path, *slot)

    def dumps(self, shapes: Shapes) -> str:
        return json.dumps({"pages": self.pages, "slots": self.slots,
                           "shape": shapes.to_lists(self.shape)}, separators=(",", ":"))

    @classmethod
    def loads(cls, text: str, shapes: Shapes) -> Wrapper:
        d = json.loads(text)
        return cls(shapes.from_lists(d["shape"]), d["slots"], d["pages"])
