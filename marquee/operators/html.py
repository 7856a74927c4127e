"""Fields of stored HTML pages as columns; pages are parsed inside the tasks.

A field spec says which elements to read. ``extract_record`` gives one row
per page, ``extract_items`` one row per repeated element of a page.
Selectors are ``tag``, ``tag.class`` or ``tag[attribute=value]``; the last
form also matches a whole class attribute.
"""

from __future__ import annotations

import re
import sys
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from html import unescape
from html.entities import html5
from itertools import accumulate, islice
from operator import le, lt
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Send this module along with the task, so executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Field:
    """What to read into one column.

    within      section to search; without it the page or item itself. A
                page without the section gives the default.
    within_nth  take this match of ``within``; its absence is an error.
    each        repeated element in the section: one list entry for each.
    select      element to read: the ``nth``, or ``many`` into a list.
    attr        read this attribute instead of the text.
    extra, sep  second element whose text is put after the first one.
    limit       number of ``each`` or ``many`` elements to look at.
    required    an element that is not there is an error.
    skip        leave out ``each`` entries without the element.
    fatal       an error in this field drops the row.
    """

    name: str
    select: str
    within: str | None = None
    within_nth: int | None = None
    each: str | None = None
    many: bool = False
    nth: int = 0
    attr: str | None = None
    extra: str | None = None
    extra_optional: bool = False
    sep: str = " "
    limit: int | None = None
    required: bool = False
    skip: bool = False
    fatal: bool = False
    default: str | tuple | None = None

    @property
    def is_list(self) -> bool:
        return self.many or self.each is not None


# Elements without content, and elements that end an open
# paragraph or an open element of their own kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",),
    "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
SCOPE = frozenset("html body ul ol dl table select div article section nav".split())
HIDDEN = frozenset(("script", "style"))  # their content is neither markup nor text

_ATTRIBUTE = r"""[\s/]*+([^\s/>=][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+"""
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_NO_GROUPS = _ATTRIBUTE.replace("(", "(?:").replace("(?:?", "(?")
# A start tag; the second form takes one whose attributes are malformed.
_START = re.compile(rf"<([a-zA-Z][^\s/>]*+)((?:{_NO_GROUPS})*+)[\s/]*+>")
_LOOSE_START = re.compile(r"<([a-zA-Z][^\s/>]*+)([^>]*+)>")
_END = re.compile(r"</([a-zA-Z][^\s/>]*+)[^>]*+>")
# A start tag, without its brackets, that the two forms read alike whatever follows it.
_PLAIN_START = re.compile(r"""([a-zA-Z][a-zA-Z0-9]*+)((?: [a-zA-Z-]++="[^"]*+")*+)""")
_PLAIN_ATTRIBUTES = re.compile(r""" ([a-zA-Z-]++)="([^"]*+)\"""")
_SELECTOR = re.compile(r"(\w+)(?:\.([\w-]+)|\[([\w-]+)=(.*)\])?\Z")


# Tags and attribute texts that a task remembers, and the longest text that it does.
REMEMBERED = 4096
LONGEST = 1024


class _Memory(dict):
    """What was read from a text, by the text. It starts anew when it is full."""

    def keep(self, text: str, value):
        if len(text) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[text] = value
        return value


class _Tag(NamedTuple):
    """What a tag does: an end tag has no ``raw``, and without a name nothing happens."""

    name: str = ""
    raw: str | None = None
    closes: tuple[tuple[str, ...], ...] = ()
    opens: bool = False
    scope: bool = False


_NOTHING = _Tag()


def _start_tag(found: re.Match, closed: bool) -> _Tag:
    tag = found[1].lower()
    closes = ((("p",),) if tag in ENDS_PARAGRAPH else ()) + ((SIBLINGS[tag],) if tag in SIBLINGS else ())
    return _Tag(tag, found[2], closes, not closed and tag not in VOID and tag not in HIDDEN, tag in SCOPE)


def _text(source: str) -> str:
    """``unescape``, without a search for names that end in a semicolon."""
    first, *others = source.split("&")
    read = [first]
    for other in others:
        name, _, rest = other.partition(";")
        char = html5.get(name + ";")
        if char is None or len(name) == len(other):
            return unescape(source)
        read.append(char)
        read.append(rest)
    return "".join(read)


def _end_tag(found: re.Match) -> _Tag:
    tag = found[1].lower()
    return _NOTHING if tag in VOID else _Tag(tag, scope=tag in SCOPE)


def _plain_tag(source: str) -> _Tag | None:
    """The tag ``<source>``, if that is the same whatever follows it; ``source`` has no ``<`` and no ``>``."""
    found = _PLAIN_START.fullmatch(source)
    if found:
        return None if found[1].lower() in HIDDEN else _start_tag(found, False)
    whole = f"<{source}>"
    if source.startswith("/"):
        found = _END.match(whole)
        return _end_tag(found) if found else None
    # A quote that is still open may go on beyond the ">".
    quoted = '"' in source or "'" in source
    found = _START.match(whole) or (None if quoted else _LOOSE_START.match(whole))
    if not found or found[1].lower() in HIDDEN:
        return None
    return _start_tag(found, source.endswith("/"))


def _tag_at(html: str, mark: int) -> tuple[_Tag, int]:
    """The tag at ``mark`` read with what follows it, and where the text after it begins."""
    following = html[mark + 1:mark + 2]
    if following == "/":
        found = _END.match(html, mark)
        return (_end_tag(found), found.end()) if found else (_NOTHING, mark)
    if following in ("!", "?"):
        comment = html.startswith("<!--", mark)
        stop = html.find("-->", mark + 4) if comment else html.find(">", mark)
        return _NOTHING, len(html) if stop < 0 else stop + (3 if comment else 1)
    found = following.isalpha() and (_START.match(html, mark) or _LOOSE_START.match(html, mark))
    if not found:
        return _NOTHING, mark  # a "<" that is text
    tag, at = _start_tag(found, html.startswith("/>", found.end() - 2)), found.end()
    if tag.name in HIDDEN:
        stop = re.compile(rf"</{tag.name}\b[^>]*>?", re.I).search(html, at)
        at = stop.end() if stop else len(html)
    return tag, at


def _read_attributes(raw: str, into: dict[str, str]) -> dict[str, str]:
    if "&" not in raw and _PLAIN_START.fullmatch("a" + raw):
        for name, value in _PLAIN_ATTRIBUTES.findall(raw):
            into.setdefault(name.lower(), value)
        return into
    for name, value in _ATTRIBUTES.findall(raw):
        if value[:1] in ('"', "'"):
            value = value[1:-1]
        into.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return into


class _Page:
    """Elements of a page in document order, with the spans they cover.

    Element ``i`` contains the elements ``i + 1`` to ``end[i]`` and the text
    pieces ``text_from[i]`` to ``text_to[i]``. Element 0 is the page itself.
    ``found`` has the elements that a selector matches, once they were looked
    for; ``tags`` and ``known`` remember tags and attributes from page to page.
    Small pages may share one: ``add`` puts a page behind the others, as the
    element it returns.
    """

    def __init__(self, html: str, tags: _Memory | None = None, known: _Memory | None = None):
        self.pieces: list[str] = []
        self.raw: list[str] = []
        self.end, self.text_from, self.text_to = [], [], []
        self.by_tag: dict[str, list[int]] = defaultdict(list)
        self._by_raw: dict[str, dict[str, list[int]]] = {}
        self.tags = _Memory() if tags is None else tags
        self.known = _Memory() if known is None else known
        self.found: dict[str, Sequence[int] | None] = {}
        self._parsed: dict[int, dict[str, str]] = {}
        self.add(html)

    def add(self, html: str) -> int:
        # Beyond the last ">" nothing is a tag, so no search for one runs on to the end again and again.
        last = html.rfind(">")
        chunks = html[:last + 1].split("<")
        chunks[-1] += html[last + 1:]
        n_chunks = len(chunks)
        starts: list[int] = []  # where the chunks begin, once that is asked for
        root, tags, by_tag = len(self.raw), self.tags, self.by_tag
        pieces, opened = self.pieces, [(root, "")]
        raws, text_from = self.raw, self.text_from
        raws.append("")
        text_from.append(len(pieces))
        end, text_to = self.end, self.text_to  # cut to the number of elements below
        end.extend(range(root, root + n_chunks))
        text_to.extend([0] * n_chunks)
        # Depths of the open elements of each tag, and of those that bound a
        # search: what an end tag closes is looked up, however deep a page is.
        depths: dict[str, list[int]] = defaultdict(list)
        barriers: list[int] = []

        def close_to(depth: int) -> None:
            last, n = len(raws) - 1, len(pieces)
            for i, tag in opened[depth:]:
                end[i], text_to[i] = last, n
                if tag:
                    depths[tag].pop()
                    if tag in SCOPE:
                        barriers.pop()
            del opened[depth:]

        if chunks[0]:
            pieces.append(chunks[0])
        k = 1
        while k < n_chunks:
            source, closed, text = chunks[k].partition(">")
            k += 1  # the chunk that follows
            found = tags.get(source) if closed else None
            if found is None:
                found = _plain_tag(source) if closed else None
                if found is not None:
                    tags.keep(source, found)
                else:
                    starts = starts or list(accumulate((len(c) + 1 for c in chunks), initial=-1))
                    found, at = _tag_at(html, starts[k - 1])
                    while starts[k] < at:  # it goes on beyond its chunk
                        k += 1
                    text = html[at:starts[k]]
            tag, raw, closes, opens, scope = found
            if raw is None:
                open_of_tag = depths.get(tag)
                if open_of_tag:
                    depth = open_of_tag[-1]
                    if depth + 1 < len(opened):
                        close_to(depth)
                    else:
                        i, _ = opened.pop()
                        end[i], text_to[i] = len(raws) - 1, len(pieces)
                        open_of_tag.pop()
                        if scope:
                            barriers.pop()
            else:
                for others in closes:
                    depth = 0
                    for other in others:
                        if depths.get(other):
                            depth = max(depth, depths[other][-1])
                    if depth and not (barriers and barriers[-1] > depth):
                        close_to(depth)
                i, n = len(raws), len(pieces)
                raws.append(raw)
                text_from.append(n)
                by_tag[tag].append(i)
                if not opens:
                    text_to[i] = n
                else:
                    follows = None
                    if k < n_chunks:
                        source, closed, after = chunks[k].partition(">")
                        follows = tags.get(source) if closed else None
                    if follows is not None and follows[1] is None and follows[0] == tag:
                        # Its own end tag comes next, so nothing else sees it open.
                        k += 1
                        if text:
                            pieces.append(text)
                            n += 1
                        text_to[i] = n
                        text = after
                    else:
                        depths[tag].append(len(opened))
                        if scope:
                            barriers.append(len(opened))
                        opened.append((i, tag))
            if text:
                pieces.append(text)
        close_to(0)
        del end[len(raws):], text_to[len(raws):]
        return root

    def by_raw(self, tag: str) -> dict[str, list[int]]:
        """The elements of a tag by their attribute texts."""
        groups = self._by_raw.get(tag)
        if groups is None:
            raws, groups = self.raw, defaultdict(list)
            for i in self.by_tag.get(tag, ()):
                groups[raws[i]].append(i)
            self._by_raw[tag] = groups
        return groups

    def attributes(self, i: int) -> dict[str, str]:
        raw = self.raw[i]
        found = self.known.get(raw)
        if found is None:
            found = self._parsed.get(i)
        if found is None:
            found = self._parsed[i] = {}
            self.known.keep(raw, _read_attributes(raw, found))  # only what could be read to its end
        return found

    def text(self, i: int) -> str:
        first, end = self.text_from[i], self.text_to[i]
        if end - first == 1:
            only = self.pieces[first]
            return _text(only) if "&" in only else only
        found = self.pieces[first:end]
        whole = "".join(found)
        return "".join(_text(t) if "&" in t else t for t in found) if "&" in whole else whole


class _Reader:
    """Reads the fields of one element according to the specs."""

    def __init__(self, fields: Sequence[Field]):
        # Fields that are the text of one element need no further look at their spec.
        self.fields = [
            (f, not (f.within or f.is_list or f.attr or f.extra or f.required)) for f in fields
        ]
        self._rules: dict[str, tuple] = {}
        self._tags, self._known = _Memory(), _Memory()

    def page(self, html: str) -> _Page:
        return _Page(html, self._tags, self._known)

    def _rule(self, selector: str) -> tuple:
        found = _SELECTOR.match(selector)
        if not found:
            raise ValueError(f"unknown selector {selector!r}")
        rule = self._rules[selector] = (*found.groups(), _Memory())
        return rule

    def _every(self, page: _Page, selector: str, odd: set[int] | None = None) -> Sequence[int] | None:
        """All matches on the page in order; None if some attributes cannot be read.

        With ``odd``, the elements with such attributes go there and the others are found.
        """
        tag, cls, attr, value, fits = self._rules.get(selector) or self._rule(selector)
        every = page.by_tag.get(tag, ())
        if cls or attr:
            every, n_fits = [], 0
            for raw, elements in page.by_raw(tag).items():
                fit = fits.get(raw)
                if fit is None:
                    fit = (cls or value) in raw or "&" in raw
                    if fit:
                        try:
                            attributes = page.known.get(raw) or page.known.keep(raw, _read_attributes(raw, {}))
                        except ValueError:
                            if odd is not None:
                                odd.update(elements)
                                continue
                            every = None
                            break
                        fit = cls in attributes.get("class", "").split() if cls else attributes.get(attr) == value
                    fits.keep(raw, fit)
                if fit:
                    every += elements
                    n_fits += 1
            if every and n_fits > 1:
                every.sort()
        page.found[selector] = every
        return every

    def matches(self, page: _Page, root: int, selector: str) -> Iterable[int]:
        every = page.found[selector] if selector in page.found else self._every(page, selector)
        if every is None:
            return self._read_in_turn(page, root, selector)
        return map(every.__getitem__, range(bisect_right(every, root), bisect_right(every, page.end[root])))

    def _read_in_turn(self, page: _Page, root: int, selector: str) -> Iterator[int]:
        """The matches one by one, so that attributes that cannot be read count only where they are reached."""
        tag, cls, attr, value, _ = self._rules[selector]
        of_tag = page.by_tag[tag]
        for k in range(bisect_right(of_tag, root), bisect_right(of_tag, page.end[root])):
            attributes = page.attributes(of_tag[k])
            if cls in attributes.get("class", "").split() if cls else attributes.get(attr) == value:
                yield of_tag[k]

    def nth(self, page: _Page, root: int, selector: str, n: int) -> int | None:
        every = page.found.get(selector)
        if every is None and selector not in page.found:
            every = self._every(page, selector)
        if every is None:
            return next(islice(self._read_in_turn(page, root, selector), n, None), None)
        k = bisect_right(every, root) + n
        return every[k] if k < len(every) and every[k] <= page.end[root] else None

    def value(self, page: _Page, i: int, f: Field) -> str:
        return page.attributes(i)[f.attr] if f.attr else page.text(i)

    def joined(self, page: _Page, root: int, f: Field) -> str | None:
        i = self.nth(page, root, f.select, f.nth)
        if i is None:
            if f.required:
                raise LookupError(f"no {f.select}")
            return f.default
        text = self.value(page, i, f)
        if f.extra:
            other = self.nth(page, root, f.extra, 0)
            if other is not None:
                text = (text + f.sep if text or f.extra_optional else text) + page.text(other)
            elif not f.extra_optional:
                raise LookupError(f"no {f.extra}")
        return text

    def read(self, page: _Page, root: int, f: Field):
        if f.within:
            section = self.nth(page, root, f.within, f.within_nth or 0)
            if section is None:
                if f.within_nth is not None:
                    raise LookupError(f"no {f.within} number {f.within_nth}")
                return f.default
            root = section
        return self.within(page, root, f)

    def within(self, page: _Page, root: int, f: Field):
        """The field read in its section."""
        if f.each:
            items = list(islice(self.matches(page, root, f.each), f.limit))
            if f.skip:
                items = [i for i in items if self.nth(page, i, f.select, f.nth) is not None]
            return [self.joined(page, i, f) for i in items]
        if f.many:
            return [self.value(page, i, f) for i in islice(self.matches(page, root, f.select), f.limit)]
        return self.joined(page, root, f)

    def row(self, page: _Page, root: int) -> tuple[list, list[str], bool]:
        """Values, errors, and whether the row as a whole failed."""
        values, errors, failed = [], [], False
        for f, plain in self.fields:
            try:
                if plain:
                    i = self.nth(page, root, f.select, f.nth)
                    value = f.default if i is None else page.text(i)
                else:
                    value = self.read(page, root, f)
            except (LookupError, ValueError) as e:
                value = f.default
                errors.append(f"{f.name}: {e}")
                failed = failed or f.fatal
            values.append(list(value) if isinstance(value, tuple) else value)
        return values, errors, failed

    def firsts(self, page: _Page, scopes: Sequence[int | None], selector: str, n: int, odd: set[int]) -> list[int | None]:
        """``nth`` for each of the scopes; None for no scope."""
        every = page.found.get(selector)
        if every is None:
            every = self._every(page, selector, odd)
        if not every:
            return [None] * len(scopes)
        end, size, found = page.end, len(every), []
        if not n and size == len(scopes) and None not in scopes and (
            all(map(lt, scopes, every)) and all(map(le, every, scopes[1:])) and all(map(le, every, map(end.__getitem__, scopes)))
        ):
            return every  # one in each scope
        for scope in scopes:
            i = None
            if scope is not None:
                k = bisect_right(every, scope) + n
                if k < size and every[k] <= end[scope]:
                    i = every[k]
            found.append(i)
        return found

    def columns(self, page: _Page, roots: Sequence[int], odd: set[int]) -> tuple[list[list], list[list[str]], list[bool]]:
        """What ``row`` gives for each of the elements, field by field.

        Elements with something that cannot be read go to ``odd``: rows of their pages are not to be used.
        """
        columns: list[list] = []
        errors: list[list[str]] = [[] for _ in roots]
        failed = [False] * len(roots)
        sections: dict[tuple[str, int], list[int | None]] = {}
        pieces, text_from, text_to = page.pieces, page.text_from, page.text_to
        for f, _ in self.fields:
            default, scopes, no_section = f.default, roots, None
            if f.within:
                key = (f.within, f.within_nth or 0)
                if key not in sections:
                    sections[key] = self.firsts(page, roots, *key, odd)
                scopes = sections[key]
                if f.within_nth is not None:
                    no_section = f"{f.name}: no {f.within} number {f.within_nth}"
            column: list = []
            in_section = f.is_list or f.extra
            if in_section:
                for selector in (f.select, f.each, f.extra):
                    if selector and selector not in page.found:
                        self._every(page, selector, odd)
                found: Sequence[int | None] = scopes
                no_element = None
            else:
                found = self.firsts(page, scopes, f.select, f.nth, odd)
                no_element = f"{f.name}: no {f.select}" if f.required else None
            if not (in_section or f.attr or None in found):
                firsts = [*map(text_from.__getitem__, found)]
                if all(text_to[i] - first == 1 for i, first in zip(found, firsts, strict=True)):
                    column = [*map(pieces.__getitem__, firsts)]
                    for at, value in enumerate(column):
                        if "&" in value:
                            try:
                                column[at] = _text(value)
                            except ValueError:
                                odd.add(roots[at])
                    columns.append(column)
                    continue
            for at, i in enumerate(found):
                error = None
                if i is None:
                    value = default
                    error = no_section if scopes[at] is None else no_element
                else:
                    try:
                        value = self.within(page, i, f) if in_section else self.value(page, i, f)
                    except LookupError as e:
                        value, error = default, f"{f.name}: {e}"
                    except ValueError:
                        odd.add(roots[at])
                        value = default
                if error:
                    errors[at].append(error)
                    if f.fatal:
                        failed[at] = True
                column.append(list(value) if type(value) is tuple else value)
            columns.append(column)
        return columns, errors, failed


# Pages parsed before their rows are handed on, and their bytes; a larger page is parsed alone.
SLICE = 512
SLICE_BYTES = 256 * 1024


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    start = size = 0
    for at, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        n = n or 0
        if at > start and (at - start >= SLICE or size + n > SLICE_BYTES):
            yield batch.slice(start, at - start)
            start, size = at, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


def _extract(
    pages: DataFrame,
    fields: Sequence[Field],
    id_cols: Sequence[str],
    html: str,
    item: str | None,
    container: str | None,
    on_error: str,
) -> DataFrame:
    if on_error not in ("drop", "keep"):
        raise ValueError(f"on_error is 'drop' or 'keep', not {on_error!r}")
    fields = tuple(fields)
    source = pages.select(*(F.col(f"`{c}`") for c in id_cols), F.col(f"`{html}`").alias("_html"))
    schema = T.StructType(
        [source.schema[c] for c in id_cols]
        + ([T.StructField("_item", T.IntegerType())] if item else [])
        + [
            T.StructField(f.name, T.ArrayType(T.StringType()) if f.is_list else T.StringType())
            for f in fields
        ]
        + [
            T.StructField("_errors", T.ArrayType(T.StringType())),
            T.StructField("_failed", T.BooleanType()),
        ]
    )
    keep_failed = on_error == "keep"

    def read(html_text: str | None, reader: _Reader) -> list[tuple]:
        page = reader.page(html_text)
        if item is None:
            return [(0, *reader.row(page, 0))]
        root = reader.nth(page, 0, container, 0) if container else 0
        if root is None:
            return []
        return [(n, *reader.row(page, i)) for n, i in enumerate(reader.matches(page, root, item))]

    def rows_of(html_text: str | None, reader: _Reader) -> list[tuple]:
        try:
            return read(html_text, reader)
        except Exception as e:  # whatever a page does, it is one failed row and not a failed job
            defaults = [list(f.default) if isinstance(f.default, tuple) else f.default for f in fields]
            return [(-1, defaults, [f"page: {e}"], True)]

    def read_together(texts: list[str | None], reader: _Reader) -> tuple[list[int], list[int], list[list], set[int]]:
        """The page and position of each row, its columns, and the pages that must be read alone."""
        alone = {page for page, text in enumerate(texts) if text is None}
        together = None
        tops, of_page = [], []
        for page, text in enumerate(texts):
            if text is not None:
                if together is None:
                    together = reader.page(text)
                    tops.append(0)
                else:
                    tops.append(together.add(text))
                of_page.append(page)
        if together is None:
            return [], [], [[]] * (len(fields) + 2), alone
        odd: set[int] = set()
        if item is None:
            roots, origin, positions = tops, of_page, [0] * len(tops)
        else:
            roots, origin, positions = [], [], []
            inside = reader.firsts(together, tops, container, 0, odd) if container else tops
            every = reader._every(together, item, odd)
            for page, root in zip(of_page, inside, strict=True):
                if root is not None:
                    found = every[bisect_right(every, root):bisect_right(every, together.end[root])]
                    roots += found
                    origin += [page] * len(found)
                    positions += range(len(found))
        columns, errors, failed = reader.columns(together, roots, odd)
        alone.update(of_page[bisect_right(tops, i) - 1] for i in odd)
        return origin, positions, [*columns, errors, failed], alone

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(fields)
        for whole in batches:
            for batch in _slices(whole, len(id_cols)):
                texts = batch.column(len(id_cols)).to_pylist()
                try:
                    origin, positions, columns, alone = read_together(texts, reader)
                except Exception:  # rows_of says what it is, page by page
                    origin, positions, columns, alone = [], [], [[]] * (len(fields) + 2), set(range(len(texts)))
                if alone or (any(columns[-1]) and not keep_failed):
                    rows = [
                        (page, n, values)
                        for page, n, *values in zip(origin, positions, *columns, strict=True)
                        if page not in alone
                    ]
                    for page in alone:
                        rows += [(page, n, [*values, *rest]) for n, values, *rest in rows_of(texts[page], reader)]
                    rows = sorted((r for r in rows if keep_failed or not r[2][-1]), key=lambda r: r[0])
                    origin, positions = [r[0] for r in rows], [r[1] for r in rows]
                    columns = [[r[2][i] for r in rows] for i in range(len(fields) + 2)]
                if not origin:
                    continue
                taken = pa.array(origin, pa.int64())
                arrays = [batch.column(i).take(taken) for i in range(len(id_cols))]
                if item:
                    arrays.append(pa.array(positions, pa.int32()))
                kinds = (*(pa.list_(pa.string()) if f.is_list else pa.string() for f in fields), pa.list_(pa.string()), pa.bool_())
                arrays += [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    rows = source.mapInArrow(task, schema)
    return rows if keep_failed else rows.drop("_failed")


def extract_record(
    pages: DataFrame,
    fields: Sequence[Field],
    id_cols: Sequence[str] = ("page_id", "url"),
    html: str = "html",
    on_error: str = "drop",
) -> DataFrame:
    """One row per page: id columns, fields, ``_errors``.

    A field that fails takes its default and is named in ``_errors``. A page
    that fails as a whole is dropped, or kept with ``_failed`` set.
    """
    return _extract(pages, fields, id_cols, html, None, None, on_error)


def extract_items(
    pages: DataFrame,
    item_selector: str,
    fields: Sequence[Field],
    container: str | None = None,
    id_cols: Sequence[str] = ("page_id", "url"),
    html: str = "html",
    on_error: str = "drop",
) -> DataFrame:
    """One row per item element: id columns, ``_item`` position, fields, ``_errors``.

    Items are looked for in the first ``container`` of the page, if one is named.
    """
    return _extract(pages, fields, id_cols, html, item_selector, container, on_error)
