"""The HTML walk: one small Arrow function that finds nodes in one page at a time.

HTML is not XML, so Spark's XML functions cannot read it. The walk returns the matched
nodes as arrays; everything after it (fallback chains, dates, de-duplication) is
DataFrame work on the exploded rows.

Markup rules: an unclosed tag stays open until an enclosing tag ends; void tags close at
once; script, style and template contents are opaque and never part of a parent's text.

Selectors: tag, ``.class``, ``#id``, ``[attr]``, ``[attr="v"]``, ``[attr^="v"]``,
``[attr*="v"]``, compounds, descendants, and comma for alternatives.
"""

from __future__ import annotations

import json
import re
import sys
from bisect import bisect_right
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from html import unescape
from html.parser import HTMLParser
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import strip

# Ship the Python helpers with the job, so that executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Tags without content.
VOID_TAGS = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex "
    "keygen link menuitem meta nextid param source spacer track wbr".split()
)
# Tags whose contents are not text.
OPAQUE_TAGS = frozenset(["script", "style", "template"])

NODE = "STRUCT<attrs: MAP<STRING, STRING>, strings: ARRAY<STRING>>"
_ARROW_ATTRS = pa.map_(pa.string(), pa.string())
_ARROW_STRINGS = pa.list_(pa.string())


class _Parser(HTMLParser):
    """Reads markup of any kind into the node list of a page."""

    def __init__(self, page: _Page, markup: str):
        super().__init__(convert_charrefs=True)
        self.page = page
        self.handle_endtag, self.handle_data = page.shut, page.add_string
        self.feed(markup)
        self.close()

    def updatepos(self, i: int, j: int) -> int:
        return j  # nobody asks for line numbers

    def handle_starttag(self, tag: str, attrs) -> None:
        if attrs:
            self.page.read_attrs[len(self.page.tags)] = {k: v or "" for k, v in attrs}
        self.page.open(tag, "")


# Fixed value: strings of nothing else shrink to one character.
_BLANKS = " \t\n\r\f\v"
_WS = r"[ \t\n\r\f]"
_ATTRS = rf"""(?:{_WS}+[^\s"'<>/=]+(?:{_WS}*={_WS}*(?:"[^"]*"|'[^']*'|[^\s"'<>=`]+))?)*+"""
# One step through plain markup: a tag, comment or doctype, each with the text behind it, or the start of a script
# or style with its content. The last group holds a "<" that none of these explain: such pages go through HTMLParser.
_STEP = re.compile(
    rf"<(?:([sS][cC][rR][iI][pP][tT]|[sS][tT][yY][lL][eE])({_ATTRS}){_WS}*>((?:[^<]++|<(?!/\s*(?i:\1)))*+)(?=</(?i:\1){_WS}*>)"
    rf"|(?:(/?)([a-zA-Z][a-zA-Z0-9:_-]*)({_ATTRS}){_WS}*(/?)|!--(?!-?>)[^-]*+(?:-(?!-)[^-]*+)*+--|![dD][oO][cC][tT][yY][pP][eE]\b[^<>]*)"
    r">([^<]*))|(<)"
)
_ATTR = re.compile(rf"""([^\s"'<>/=]+)(?:{_WS}*={_WS}*("[^"]*"|'[^']*'|[^\s"'<>=`]+))?""")
# Markup that HTMLParser reads in a way of its own, as text up to an end tag.
_RAW_TAGS = frozenset("script style textarea xmp iframe noembed noframes plaintext".split())


# What stands before a value in double quotes, and its name; the same few come again and again.
_BEFORE_VALUE = re.compile(rf"""{_WS}+([^\s"'<>/=]+){_WS}*={_WS}*""")
_NAMES: dict[str, str | None] = {}


def _name_before(chunk: str) -> str | None:
    """The attribute's name in a chunk before a double quote; None if it is anything else."""
    if chunk not in _NAMES:
        if len(_NAMES) >= _MEMORY:
            _NAMES.clear()
        match = _BEFORE_VALUE.fullmatch(chunk)
        _NAMES[chunk] = match.group(1).lower() if match else None
    return _NAMES[chunk]


def _read_attrs(text: str) -> dict[str, str]:
    """Attributes as they stand in a plain start tag."""
    attrs = {}
    parts = text.split('"')
    if not parts[-1] and len(parts) % 2:  # perhaps all values are in double quotes
        for chunk, value in zip(parts[::2], parts[1::2]):
            name = _name_before(chunk)
            if name is None:
                break
            attrs[name] = unescape(value) if "&" in value else value
        else:
            return attrs
        attrs = {}
    for name, value in _ATTR.findall(text):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        attrs[name.lower()] = unescape(value) if "&" in value else value
    return attrs


class _Page:
    """Flat node list of one page: (tag, attrs, parent, last descendant, first and last string).

    Attributes of plain markup are read when they are asked for.
    """

    def __init__(self, markup: str):
        self._reset()
        self._plain = markup  # None if raw does not hold the attributes as they stand here
        if not self._read_plain(markup):
            self._reset()
            self._plain = None
            _Parser(self, markup)
        while self._open:
            self._close_top()

    def _reset(self) -> None:
        self.tags: list[str] = []
        self.raw: list[str] = []  # attributes as they stand, "" where read_attrs has them
        self.read_attrs: dict[int, dict[str, str]] = {}
        self.parent: list[int] = []
        self.end: list[int] = []
        self.first_string: list[int] = []
        self.last_string: list[int] = []
        self.strings: list[str] = []
        self.kinds: dict[int, str] = {}  # of the strings in opaque tags
        self.by_tag: dict[str, list[int]] = {}
        self.found: dict[str, list[int]] = {}
        self._open: list[int] = []
        self._coded: bool | None = None  # whether an attribute has entities, once it is asked for

    def _read_plain(self, markup: str) -> bool:
        """Read markup of usual form; False if some of it is not."""
        start = markup.find("<")
        if start < 0:
            return False
        if start:
            self.add_string(unescape(markup[:start]))
        tags, raws, parents, ends = self.tags, self.raw, self.parent, self.end
        firsts, lasts, strings, by_tag, opened = self.first_string, self.last_string, self.strings, self.by_tag, self._open
        opaque = False
        for raw_tag, raw_attrs, content, slash, tag, attrs, empty, text, stray in _STEP.findall(markup):
            if tag and slash:
                if attrs or empty:
                    return False
                tag = tag.lower()
                if opened and tags[opened[-1]] == tag:
                    node = opened.pop()
                    ends[node] = len(tags) - 1
                    lasts[node] = len(strings)
                else:
                    self.shut(tag)
            elif tag:
                tag = tag.lower()
                if tag in _RAW_TAGS:
                    return False
                node = len(tags)
                tags.append(tag)
                if tag in by_tag:
                    by_tag[tag].append(node)
                else:
                    by_tag[tag] = [node]
                raws.append(attrs)
                parents.append(opened[-1] if opened else -1)
                ends.append(node)
                firsts.append(len(strings))
                lasts.append(len(strings))
                if not empty and tag not in VOID_TAGS:
                    opened.append(node)
                    opaque = opaque or tag == "template"
            elif raw_tag:
                if "\u017f" in content:  # HTMLParser takes it for an s
                    return False
                self.open(raw_tag.lower(), raw_attrs)
                if content:
                    self.add_string(content)
                continue
            elif stray:
                return False
            if text:
                if "&" in text:
                    text = unescape(text)
                if opaque:
                    self.add_string(text)
                else:
                    strings.append(text)
        return True

    def open(self, tag: str, attrs: str) -> None:
        node = len(self.tags)
        self.tags.append(tag)
        self.by_tag.setdefault(tag, []).append(node)
        self.raw.append(attrs)
        self.parent.append(self._open[-1] if self._open else -1)
        self.end.append(node)
        self.first_string.append(len(self.strings))
        self.last_string.append(len(self.strings))
        if tag not in VOID_TAGS:
            self._open.append(node)

    def shut(self, tag: str) -> None:
        depth = next((d for d in reversed(range(len(self._open))) if self.tags[self._open[d]] == tag), None)
        if depth is not None:
            while len(self._open) > depth:
                self._close_top()

    def _close_top(self) -> None:
        node = self._open.pop()
        self.end[node] = len(self.tags) - 1
        self.last_string[node] = len(self.strings)

    def add_string(self, data: str) -> None:
        inside = self.tags[self._open[-1]] if self._open else ""
        if inside in OPAQUE_TAGS:
            self.kinds[len(self.strings)] = inside
        self.strings.append(data)

    def attrs(self, node: int) -> dict[str, str]:
        found = self.read_attrs.get(node)
        if found is None:
            found = self.read_attrs[node] = _read_attrs(self.raw[node])
        return found

    def may_hold(self, mark: str) -> bool:
        """False if no attribute of the page can hold this text."""
        if self._plain is None or mark in self._plain:
            return True
        if self._coded is None:
            self._coded = "&" in self._plain and any("&" in raw for raw in self.raw)
        return self._coded

    def strings_of(self, node: int) -> list[str]:
        first, last = self.first_string[node], self.last_string[node]
        own = self.strings[first:last]
        kind = self.tags[node] if self.tags[node] in OPAQUE_TAGS else ""
        if kind or self.kinds:
            own = [s for at, s in enumerate(own, first) if self.kinds.get(at, "") == kind]
        return [s if s.strip(_BLANKS) else "\n" if "\n" in s else " " for s in own]


_PART = re.compile(r"([#.]?)([\w-]+)|\[([\w-]+)(?:([*^]?=)[\"']?([^\"'\]]*)[\"']?)?\]")
Test = Callable[[dict[str, str]], bool]
# Attribute texts a compound remembers; classes come again and again, links do not.
_MEMORY = 2000


class _Compound:
    """What one compound such as ``a.note[href]`` asks of a node."""

    def __init__(self, compound: str):
        self.tags: list[str] = []
        self.tests: list[Test] = []
        self.known: dict[str, bool] = {}
        self.mark = ""  # what the attributes of a match must hold
        for mark, name, attr, op, value in _PART.findall(compound):
            if mark == ".":
                self.tests.append(lambda at, n=name: n in at.get("class", "").split())
            elif mark == "#":
                self.tests.append(lambda at, n=name: at.get("id") == n)
            elif name:
                self.tags.append(name)
            elif op == "*=":
                self.tests.append(lambda at, a=attr, v=value: v in at.get(a, ""))
            elif op == "^=":
                self.tests.append(lambda at, a=attr, v=value: at.get(a, "").startswith(v))
            elif op == "=":
                self.tests.append(lambda at, a=attr, v=value: at.get(a) == v)
            else:
                self.tests.append(lambda at, a=attr: a in at)
            if mark or value:
                self.mark = max(self.mark, name if mark else value, key=len)
        self.bare = all(test({}) for test in self.tests)  # whether a node without attributes fits

    def fitting(self, page: _Page, nodes: Sequence[int]) -> list[int]:
        """Those of the nodes that fit."""
        for tag in self.tags:
            tags = page.tags
            nodes = [n for n in nodes if tags[n] == tag]
        if not self.tests:
            return list(nodes)
        mark, known, raws, read = self.mark, self.known, page.raw, page.read_attrs
        out = []
        for node in nodes:
            raw = raws[node]
            if raw:
                if mark not in raw and "&" not in raw:
                    continue
                fits = known.get(raw)
                if fits is None:
                    fits = self.fits(page, node)
            else:
                fits = self.bare if node not in read else self.fits(page, node)
            if fits:
                out.append(node)
        return out

    def fits(self, page: _Page, node: int) -> bool:
        for tag in self.tags:
            if page.tags[node] != tag:
                return False
        if not self.tests:
            return True
        raw = page.raw[node]
        if raw and self.mark not in raw and "&" not in raw:
            return False
        fits = self.known.get(raw) if raw else None
        if fits is None:
            attrs = page.attrs(node)
            fits = all([test(attrs) for test in self.tests])
            if raw:
                if len(self.known) >= _MEMORY:
                    self.known.clear()
                self.known[raw] = fits
        return fits


@dataclass
class _Selector:
    """Alternatives, each a list of compounds from the outermost to the node itself."""

    css: str
    alternatives: list[list[_Compound]]
    tags: list[str] | None  # the only tags a match can have, when every alternative names one
    tag_only: bool  # a tag's name is all it asks for


def _compile(css: str) -> _Selector:
    parts = [alternative.split() for alternative in css.split(",")]
    named = [re.match(r"[\w-]+", compounds[-1]) for compounds in parts]
    tags = sorted({m.group() for m in named}) if all(named) else None
    alternatives = [[_Compound(c) for c in compounds] for compounds in parts]
    tag_only = all(len(a) == 1 and len(a[0].tags) == 1 and not a[0].tests for a in alternatives)
    return _Selector(css, alternatives, tags, tag_only and len(tags or ()) == 1)


def _stands_in(page: _Page, node: int, compounds: list[_Compound]) -> bool:
    """Whether the nodes around this one fit all compounds but the last."""
    at = node
    open_compounds = len(compounds) - 1
    while open_compounds and (at := page.parent[at]) >= 0:
        if compounds[open_compounds - 1].fits(page, at):
            open_compounds -= 1
    return not open_compounds


def _all_matches(page: _Page, selector: _Selector) -> list[int]:
    """Matches on the whole page, in document order; worked out once per page."""
    found = page.found.get(selector.css)
    if found is None:
        if selector.tag_only:
            found = page.by_tag.get(selector.tags[0], [])
        else:
            found = []
            for compounds in selector.alternatives:
                if not all([page.may_hold(c.mark) for c in compounds]):
                    continue
                last = compounds[-1]
                hits = last.fitting(page, page.by_tag.get(last.tags[0], ()) if last.tags else range(len(page.tags)))
                if len(compounds) > 1:
                    hits = [n for n in hits if _stands_in(page, n, compounds)]
                found = sorted({*found, *hits}) if found else hits
        page.found[selector.css] = found
    return found


def _find(page: _Page, scope: int, selector: _Selector, first: bool = False) -> list[int]:
    """Descendants of ``scope`` (-1 is the page) that match, in document order."""
    return _inside(page, scope, _all_matches(page, selector), first)


def _inside(page: _Page, scope: int, found: list[int], first: bool) -> list[int]:
    if scope < 0:
        return found[:1] if first else found
    low = bisect_right(found, scope)
    if first:
        return found[low : low + 1] if low < len(found) and found[low] <= page.end[scope] else []
    return found[low : bisect_right(found, page.end[scope], low)]


def select_nodes(markup: Column, selectors: Mapping[str, str]) -> Column:
    """All nodes matching any of the named selectors, in document order.

    A node that fits two selectors comes twice. ``parent_pos`` is -1 for a root;
    ``end_pos`` is the position of the last descendant.
    """
    shape = pa.list_(
        pa.struct(
            [
                ("selector", pa.string()),
                ("pos", pa.int32()),
                ("parent_pos", pa.int32()),
                ("end_pos", pa.int32()),
                ("tag", pa.string()),
                ("attrs", _ARROW_ATTRS),
                ("strings", _ARROW_STRINGS),
            ]
        )
    )
    named = dict(selectors)

    @F.arrow_udf(
        "ARRAY<STRUCT<selector: STRING, pos: INT, parent_pos: INT, end_pos: INT, tag: STRING, "
        "attrs: MAP<STRING, STRING>, strings: ARRAY<STRING>>>"
    )
    def walk(batch: pa.Array) -> pa.Array:
        tests = [(name, _compile(css)) for name, css in named.items()]

        def rows(text: str | None) -> list[dict]:
            if not text:
                return []
            page = _Page(text)
            hits = sorted((n, at) for at, (_, sel) in enumerate(tests) for n in _all_matches(page, sel))
            return [
                {
                    "selector": tests[at][0],
                    "pos": node,
                    "parent_pos": page.parent[node],
                    "end_pos": page.end[node],
                    "tag": page.tags[node],
                    "attrs": list(page.attrs(node).items()),
                    "strings": page.strings_of(node),
                }
                for node, at in hits
            ]

        return pa.array([rows(t.as_py()) for t in batch], type=shape)

    return walk(markup)


class _Section:
    """One compiled section of a rule, applied to one page at a time."""

    def __init__(self, spec: Mapping):
        self.items = _compile(spec["items"])
        self.first = spec.get("first", False)
        self.fallback = spec.get("fallback", False)
        self.fields = [
            (name, name in spec.get("every", ()), name in spec.get("ancestors", ()),
             [[_compile(step) for step in steps] for steps in candidates])
            for name, candidates in spec["fields"].items()
        ]

    def rows(self, page: _Page, rank: int) -> list[dict]:
        def look_up(scope: int, steps: list[_Selector], every: bool) -> list[int]:
            inner = [scope]
            for selector in steps[:-1]:
                inner = _find(page, inner[0], selector, first=True) if inner else []
            return _find(page, inner[0], steps[-1], first=not every) if inner else []

        def node(n: int) -> dict:
            return {"attrs": list(page.attrs(n).items()), "strings": page.strings_of(n)}

        def scopes(item: int, ancestors: bool) -> list[int]:
            near = [item]
            while ancestors and len(near) < 3 and near[-1] >= 0:
                near.append(page.parent[near[-1]])
            return near

        # Most candidates of a rule match nothing on a given page.
        live = [
            (name, every, ancestors, [c for c in candidates if all(_all_matches(page, s) for s in c)])
            for name, every, ancestors, candidates in self.fields
        ]
        return [
            {
                "section": rank,
                "pos": item,
                "item": node(item),
                "fields": [
                    (name, [
                        node(n)
                        for scope in scopes(item, ancestors)
                        for steps in candidates
                        for n in look_up(scope, steps, every)
                    ])
                    for name, every, ancestors, candidates in live
                ],
            }
            for item in _find(page, -1, self.items, self.first)
        ]


def select_items(markup: Column, rule_id: Column, rules: Mapping[str, Sequence[Mapping]]) -> Column:
    """The item nodes of each page under the rule of its site, each with its field nodes.

    A rule is a list of sections in order of precedence. A section has ``items`` (selector;
    ``first`` keeps the first match only; a ``fallback`` section counts only when those
    before it found nothing) and ``fields``: name -> list of candidates. A
    candidate is a tuple of selectors, each looked up inside the first match of the one
    before it. The last gives its first match, or all of them for fields named in
    ``every``. Fields named in ``ancestors`` are searched in the item, then in its parent,
    then in its grandparent. Nodes come in the order of the candidates.
    """
    node = pa.struct([("attrs", _ARROW_ATTRS), ("strings", _ARROW_STRINGS)])
    fields = pa.map_(pa.string(), pa.list_(node))
    shape = pa.list_(
        pa.struct([("section", pa.int32()), ("pos", pa.int32()), ("item", node), ("fields", fields)])
    )
    specs = {name: [dict(s) for s in sections] for name, sections in rules.items()}

    @F.arrow_udf(
        f"ARRAY<STRUCT<section: INT, pos: INT, item: {NODE}, fields: MAP<STRING, ARRAY<{NODE}>>>>"
    )
    def walk(markups: pa.Array, rule_ids: pa.Array) -> pa.Array:
        ready = {name: [_Section(s) for s in sections] for name, sections in specs.items()}

        def rows(text: str | None, rule: str | None) -> list[dict]:
            if not text or rule not in ready:
                return []
            page = _Page(text)
            found: list[dict] = []
            for rank, section in enumerate(ready[rule]):
                if not (section.fallback and found):
                    found += section.rows(page, rank)
            return found

        return pa.array([rows(t.as_py(), r.as_py()) for t, r in zip(markups, rule_ids)], type=shape)

    return walk(markup, rule_id)


def node_text(node: Column) -> Column:
    """All text of a node, trimmed at the ends only."""
    return strip(F.array_join(node["strings"], ""))


def _pieces(node: Column) -> Column:
    return F.filter(F.transform(node["strings"], strip), lambda s: s != "")


def tight_text(node: Column) -> Column:
    """Each piece of text trimmed, then glued together."""
    return F.array_join(_pieces(node), "")


def spaced_text(node: Column) -> Column:
    """Each piece of text trimmed, then joined with one space."""
    return F.array_join(_pieces(node), " ")


class _Read:
    """One way to a field's text: where to look inside an item, what to take, and which texts count."""

    def __init__(self, spec: Mapping):
        self.field, self.section = spec["field"], spec.get("section")
        self.path = [_compile(step) for step in spec.get("path") or ()]
        self.take, self.near = spec.get("take") or "first", bool(spec.get("near"))
        self.form, self.attr = _FORMS[spec.get("form") or "text"], spec.get("attr")
        self.lone = _LONE.get(spec.get("form") or "text")
        self.least = 1 if spec.get("min_chars") is None else spec["min_chars"]
        self.pattern = re.compile(spec["pattern"]) if spec.get("pattern") else None
        self.reject = re.compile(spec["reject"]) if spec.get("reject") else None
        self.value = spec.get("value")

    def nodes(self, page: _Page, scope: int, steps: list[list[int]]) -> Sequence[int]:
        """Where to read; ``steps`` are the matches of each selector of the path on the page."""
        if not steps:
            return (scope,)
        for number, found in enumerate(steps, 1):
            at = bisect_right(found, scope)
            end = page.end[scope] if scope >= 0 else len(page.tags)
            if at == len(found) or found[at] > end:
                return ()
            if number < len(steps) or self.take == "first":
                scope = found[at]
            else:
                nodes = found[at : bisect_right(found, end, at)]
                return nodes[-1:] if self.take == "last" else nodes
        return (scope,)

    def texts(self, page: _Page, nodes: Sequence[int]) -> Iterator[str]:
        """The texts that count."""
        for node in nodes:
            text = page.attrs(node).get(self.attr) if self.attr else self.text(page, node)
            if text is not None and self.pattern:
                match = self.pattern.search(text)
                text = match.group(match.re.groups and 1) if match else None
            if text is None or len(text) < self.least or (self.reject and self.reject.search(text)):
                continue
            yield text if self.value is None else self.value

    def text(self, page: _Page, node: int) -> str:
        first = page.first_string[node]
        if page.last_string[node] == first + 1 and not page.kinds and self.lone and page.tags[node] not in OPAQUE_TAGS:
            return self.lone(page.strings[first])
        return self.form(page.strings_of(node))


# The forms of a single string; blanks in it need not shrink first, as its ends are stripped.
_LONE: dict[str, Callable[[str], str]] = {
    **dict.fromkeys(("text", "tight", "spaced"), str.strip),
    "collapsed": lambda string: " ".join(string.split()),
}
_FORMS: dict[str, Callable[[list[str]], str]] = {
    "text": lambda strings: "".join(strings).strip(),
    "joined": "".join,
    "tight": lambda strings: "".join(s for s in (x.strip() for x in strings) if s),
    "spaced": lambda strings: " ".join(s for s in (x.strip() for x in strings) if s),
    "collapsed": lambda strings: " ".join("".join(strings).split()),
}
READ_FIELDS = ("link", "title", "description", "category")


class _Program:
    """A rule's sections and reads, compiled once for all pages of a task that have the same rule text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        self.sections = [(_compile(s["items"]), s.get("first"), s.get("fallback")) for s in spec["sections"]]
        reads = [_Read(r) for r in spec["reads"]]
        # Reads of one field that look around go outwards together.
        groups = [list(g) for _, g in groupby(reads, key=lambda r: (r.field, r.section, r.near))]
        self.groups = [
            [(g[0].field, 3 if g[0].near else 1, g) for g in groups if g[0].section in (None, rank)]
            for rank in range(len(self.sections))
        ]

    def rows(self, page: _Page) -> list[tuple]:
        """(section, pos, link, title, description, category, dates) of each item."""
        found: list[tuple] = []
        for rank, (items, first, fallback) in enumerate(self.sections):
            at = _find(page, -1, items, bool(first)) if not (fallback and found) else []
            if at:
                live = [(field, reach, reads) for field, reach, group in self.groups[rank] if (reads := self.live(page, group))]
                found += [self.row(page, rank, item, live) for item in at]
        return found

    @staticmethod
    def live(page: _Page, reads: list[_Read]) -> list[tuple[_Read, list[list[int]]]]:
        """Reads that can find something on the page (most match nothing there), with their steps' matches."""
        steps = [(read, [_all_matches(page, selector) for selector in read.path]) for read in reads]
        return [(read, found) for read, found in steps if all(found)]

    def row(self, page: _Page, rank: int, item: int, live: list) -> tuple:
        row: dict = {}
        dates: list[str] = []
        for field, reach, reads in live:
            if field in row:
                continue
            scope = item
            for _ in range(reach):
                for read, steps in reads:
                    nodes = read.nodes(page, scope, steps)
                    if not nodes:
                        continue
                    if field == "date":
                        dates += read.texts(page, nodes)
                    elif (text := next(read.texts(page, nodes), None)) is not None:
                        row[field] = text
                        break
                if field in row:
                    break
                scope = page.parent[scope] if scope >= 0 else -1
        return rank, item, *map(row.get, READ_FIELDS), dates


def read_items(markup: Column, program: Column) -> Column:
    """The items of each page under the rule in its own row, each with its fields' texts.

    ``program`` is a rule as JSON: ``sections`` (items, first, fallback; see ``select_items``) and ``reads``, tried in
    order for each field: field (link, title, description, category or date), section (its number; all if absent),
    path (selectors, each inside the first match of the one before; none is the item itself), take (first,
    last or every match), near (look in the item, its parent and grandparent), form (text, tight, spaced,
    collapsed or joined) or attr, pattern (what it finds, or its first group, is the text), min_chars (1), reject (texts
    that do not count), value (stands for any text that counts). The first text that counts is the field's; of dates all
    are given. Pages or programs that are null have no items.
    """
    kinds = [pa.int32(), pa.int32(), *[pa.string() for _ in READ_FIELDS], pa.list_(pa.string())]
    names = ["section", "pos", *READ_FIELDS, "dates"]
    fields = ", ".join(f"{f}: STRING" for f in READ_FIELDS)

    @F.arrow_udf(f"ARRAY<STRUCT<section: INT, pos: INT, {fields}, dates: ARRAY<STRING>>>")
    def walk(markups: pa.Array, programs: pa.Array) -> pa.Array:
        coded = programs.dictionary_encode()  # few programs, each on many pages
        ready = [_Program(p) if p else None for p in coded.dictionary.to_pylist()]
        rows: list[tuple] = []
        offsets = [0]
        for text, at in zip(markups.to_pylist(), coded.indices.to_pylist()):
            program = None if at is None else ready[at]
            if text and program:
                rows += program.rows(_Page(text))
            offsets.append(len(rows))
        columns = zip(*rows) if rows else [()] * len(names)
        arrays = [pa.array(c, type=kind) for c, kind in zip(columns, kinds)]
        return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.StructArray.from_arrays(arrays, names=names))

    return walk(markup, program)
