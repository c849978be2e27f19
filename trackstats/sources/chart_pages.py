"""Chart rows of whole stored pages as arrays, inside the task that read the pages.

A run of pages is one array of bytes. Its tags are found and matched for all
pages at once; the cells that count are cut out, freed of tags and references
and read as numbers as arrays too. A page with a tag that is not plain (blanks
in an end tag, ``<`` in a tag, an end before the first table) is read by itself
with the expressions that ``pages`` has as columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import name2codepoint

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pages are read in runs of about this many bytes; a longer page is a run of its own.
CHUNK = 1 << 19
#: What is cut off around the text of a cell.
BLANKS = " \t\r\n\u00a0"
NAMES = {**{n: chr(c) for n, c in name2codepoint.items()}, "apos": "'"}

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LT, _GT, _AMP, _SEMICOLON, _SLASH = b"<>&;/"
_EITHER = np.uint8(0xFF ^ _LT ^ _GT)  # the bits that ``<`` and ``>`` share
_DELIMITS = _SPACE.copy()
_DELIMITS[_GT] = True
TABLE, ROW, CELL = range(3)
#: A tag by the letter behind its ``t``, either case.
_KIND = np.full(256, -1, np.int8)
for _letters, _kind in ((b"aA", TABLE), (b"rR", ROW), (b"dD", CELL)):
    _KIND[list(_letters)] = _kind
_HTML = re.I | re.A | re.S


# --- one page ------------------------------------------------------------------

def character(reference: str) -> str | None:
    """The character of a reference without ``&`` and ``;``, None if there is none."""
    if not reference.startswith("#"):
        return NAMES.get(reference)
    found = re.fullmatch(r"#(?:([0-9]{1,7})|[xX]([0-9a-fA-F]{1,6}))", reference)
    n = 0 if not found else int(found[1]) if found[1] else int(found[2], 16)
    return chr(n) if 1 <= n <= 0xD7FF or 0xE000 <= n <= 0x10FFFF else None


def _decoded(text: str) -> str:
    first, *parts = text.split("&")
    for i, part in enumerate(parts):
        reference, end, rest = part.partition(";")
        c = character(reference) if end else None
        parts[i] = "&" + part if c is None else c + rest
    return first + "".join(parts)


def _cell_text(html: str) -> str:
    return _decoded(re.sub(r"\s*<[^>]*>\s*", "", html, flags=re.A)).strip(BLANKS)


def _whole(bare: str) -> int | None:
    """Number of a text without commas and blanks; a line end may follow, what exceeds 64 bits is none."""
    found = re.fullmatch(r"([-+]?[0-9]+)(?:\r\n|\n|\r)?", bare)
    digits = found[1].lstrip("+-").lstrip("0") if found else ""
    n = int(found[1]) if found and len(digits) < 20 else 1 << 63
    return n if -(1 << 63) <= n < 1 << 63 else None


def _first_table(html: str) -> str:
    pieces = re.split(r"(?=</?table[\s>])", html, flags=_HTML)
    opens = [bool(re.match(r"<table[\s>]", p, _HTML)) for p in pieces]
    if sum(opens) < 2:
        simple = re.search(r"<table(?=[\s>])[^>]*>(.*?)</table\s*>", html, _HTML)
        return simple[1] if simple else ""
    depth, inside = 0, []
    for piece, start in zip(pieces, opens, strict=True):
        if start:
            depth += 1
        elif depth and re.match(r"</table[\s>]", piece, _HTML):
            depth -= 1
            if not depth:
                break
        if depth:
            inside.append(piece)
    return re.sub(r"\A<table(?=[\s>])[^>]*>", "", "".join(inside), flags=_HTML)


def page_rows(html: str) -> list[tuple[str, int, int]]:
    """``(text, streams, daily)`` of the chart rows of one page, whatever its tags look like."""
    out = []
    for row in re.findall(r"<tr(?=[\s>])[^>]*>(.*?)</tr\s*>", _first_table(html), _HTML)[1:]:
        cells = re.findall(r"<td(?=[\s>])[^>]*>(.*?)</td\s*>", row, _HTML)
        numbers = [_whole(_cell_text(c).replace(",", "").strip(" ")) for c in cells[1:3]]
        if len(numbers) == 2 and None not in numbers:
            out.append((_cell_text(cells[0]), *numbers))
    return out


# --- texts as arrays: all bytes, and where each text begins (one more than there are texts) ---------

Texts = tuple[np.ndarray, np.ndarray]


def _cut(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> Texts:
    """The parts of an array that begin at ``start``, one behind the other."""
    at = np.concatenate([[0], np.cumsum(size)])
    return data[np.arange(at[-1]) + np.repeat(start - at[:-1], size)], at


def _paired(owner: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of starts and of their ends: what starts holds until the next end, other starts in it count for nothing."""
    free = np.ones(len(owner), bool)
    free[1:] = ~opens[:-1] | (owner[1:] != owner[:-1])
    start, ends = np.flatnonzero(opens & free), np.flatnonzero(~opens)
    at = np.searchsorted(ends, start)
    start, stop = start[at < len(ends)], ends[at[at < len(ends)]]
    same = owner[start] == owner[stop]
    return start[same], stop[same]


def _owners(place: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text of every place; places ascend."""
    return np.repeat(np.arange(len(at) - 1), np.diff(np.searchsorted(place, at)))


def _replaced(texts: Texts, low: np.ndarray, high: np.ndarray, by: bytes = b"", start=0, size=0) -> Texts:
    """Parts from ``low`` to ``high``, each within a text, replaced by the bytes of ``by`` from ``start`` on."""
    data, at = texts
    starts, sizes = np.zeros(2 * len(low) + 1, np.int64), np.zeros(2 * len(low) + 1, np.int64)
    starts[2::2], starts[1::2] = high, start + len(data)
    sizes[0::2], sizes[1::2] = np.append(low, len(data)) - starts[0::2], size
    lost = np.concatenate([[0], np.cumsum(high - low - size)])
    made, _ = _cut(np.concatenate([data, np.frombuffer(by, np.uint8)]), starts, sizes)
    return made, at - lost[np.searchsorted(low, at)]


def _without_tags(texts: Texts) -> Texts:
    """Tags and the blanks around them taken out."""
    data, at = texts
    place = np.flatnonzero(data & _EITHER == _LT)
    opens = data[place] == _LT
    if not opens.any():
        return texts
    owner = _owners(place, at)
    start, stop = _paired(owner, opens)
    solid = np.flatnonzero(~_SPACE[data])
    low, high, owner = place[start], place[stop] + 1, owner[start]
    before = solid[np.searchsorted(solid, low) - 1] + 1  # what is behind the last that is not blank
    low = np.maximum(np.where(before <= low, before, 0), at[owner])
    high = np.minimum(np.append(solid, len(data))[np.searchsorted(solid, high)], at[owner + 1])
    low[1:] = np.maximum(low[1:], high[:-1])  # blanks between two tags go once
    return _replaced(texts, low, high)


def _without_references(texts: Texts) -> Texts:
    """Character references replaced, each once; unknown ones stay."""
    data, at = texts
    amp = np.flatnonzero(data == _AMP)
    if not len(amp):
        return texts
    semicolon = np.append(np.flatnonzero(data == _SEMICOLON), len(data))
    end = semicolon[np.searchsorted(semicolon, amp)]
    ended = end < np.minimum(np.append(amp[1:], len(data)), at[_owners(amp, at) + 1])
    amp, end = amp[ended], end[ended]
    found = _array(_cut(data, amp + 1, end - amp - 1), pa.binary()).dictionary_encode()
    known = [character(r.decode()) for r in found.dictionary.to_pylist()]
    spelled = [c.encode() if c else b"" for c in known]
    size = np.array([len(c) for c in spelled], np.int64)
    which = np.asarray(found.indices)
    real = np.array([c is not None for c in known], bool)[which]
    which = which[real]
    return _replaced(texts, amp[real], end[real] + 1, b"".join(spelled), (np.cumsum(size) - size)[which], size[which])


def _array(texts: Texts, kind: pa.DataType) -> pa.Array:
    data, at = texts
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _cell_texts(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.Array:
    bare = _without_references(_without_tags(_cut(data, start, stop - start)))
    return pc.utf8_trim(_array(bare, pa.string()), characters=BLANKS)


def _numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of texts, and which texts are one."""
    bare = pc.ascii_trim(pc.replace_substring(texts, ",", ""), characters=" ")
    plain = np.asarray(pc.match_substring_regex(bare, "^-?[0-9]{1,18}$"))
    value, given = np.zeros(len(plain), np.int64), plain.copy()
    value[plain] = np.asarray(pc.cast(bare.filter(pa.array(plain)), pa.int64()))
    for i in np.flatnonzero(~plain & np.asarray(pc.match_substring_regex(bare, "^[-+]?[0-9]"))):
        n = _whole(bare[i].as_py())
        value[i], given[i] = (0, False) if n is None else (n, True)
    return value, given


# --- a run of pages ----------------------------------------------------------------

class _Tags:
    """Tags of tables, rows and cells in a run of pages, in their order."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        mark = np.append(np.flatnonzero(data & _EITHER == _LT), len(data))
        seen = np.concatenate([data, np.zeros(8, np.uint8)])
        less = np.flatnonzero(seen[mark[:-1]] == _LT)
        begin, end = mark[less], mark[less + 1]
        name = begin + 1 + (seen[begin + 1] == _SLASH)
        some = np.flatnonzero(seen[name] | 0x20 == ord("t"))
        begin, end, name = begin[some], end[some], name[some]
        kind = _KIND[seen[name + 1]]
        table = np.flatnonzero(kind == TABLE)
        for i, c in enumerate(b"ble", 2):
            kind[table[seen[name[table] + i] | 0x20 != c]] = -1
        behind = name + np.where(kind == TABLE, 5, 2)  # what stands behind the name
        page = _owners(begin, at)
        ends = at[page + 1]
        real = np.flatnonzero((kind >= 0) & (behind < ends) & _DELIMITS[seen[behind]])
        #: The next mark after a tag's begin is its end, else its page is odd.
        self.begin, self.end, self.kind, self.page = begin[real], end[real], kind[real], page[real]
        self.opens = seen[self.begin + 1] != _SLASH
        plain = np.where(self.opens, (seen[self.end] == _GT) & (self.end < ends[real]), self.end == behind[real])
        self.odd = np.zeros(len(at) - 1, bool)
        self.odd[self.page[~plain]] = True

    def where(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return self.begin[mask], self.end[mask], self.page[mask], self.opens[mask]


def _insides(tags: _Tags, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the first table of every page begins and ends, and the pages whose first tag of a table is an end."""
    n = len(at) - 1
    begin, end, page, opens = tags.where(tags.kind == TABLE)
    first = np.flatnonzero(np.diff(page, prepend=-1))
    step = np.where(opens, 1, -1)
    total = np.cumsum(step)
    depth = total - np.repeat((total - step)[first], np.diff(np.append(first, len(page))))
    low, high = at[:-1].copy(), at[:-1].copy()
    low[page[first]] = end[first] + 1
    several = np.bincount(page[opens], minlength=n) > 1  # without an end such a table reaches to the page's end
    high[several] = at[1:][several]
    closed = np.flatnonzero(depth == 0)[::-1]
    high[page[closed]] = begin[closed]  # the first of a page is written last
    return low, high, page[first][~opens[first]]


def _run_rows(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Page, text and numbers of the chart rows of a run, and the pages that have to be read one by one."""
    tags = _Tags(data, at)
    low, high, late = _insides(tags, at)
    tags.odd[late] = True
    fit = ~tags.odd[tags.page] & (tags.begin >= low[tags.page]) & (tags.begin < high[tags.page])

    begin, end, page, opens = tags.where(fit & (tags.kind == ROW))
    start, stop = _paired(page, opens)
    row_page, row_low, row_high = page[start], end[start] + 1, begin[stop]
    header = np.diff(row_page, prepend=-1) != 0

    begin, end, _, opens = tags.where(fit & (tags.kind == CELL))
    row = np.cumsum(np.bincount(np.searchsorted(begin, row_low), minlength=len(begin) + 1))[:-1] - 1
    held = row >= 0
    held[held] &= begin[held] < row_high[row[held]]
    begin, end, row, opens = begin[held], end[held], row[held], opens[held]
    start, stop = _paired(row, opens)
    cell_row, cell_low, cell_high = row[start], end[start] + 1, begin[stop]
    count = np.bincount(cell_row, minlength=len(row_page))
    cell = (np.cumsum(count) - count)[(count >= 3) & ~header]
    page = row_page[(count >= 3) & ~header]

    streams, given = _numbers(_cell_texts(data, cell_low[cell + 1], cell_high[cell + 1]))
    cell, page, streams = cell[given], page[given], streams[given]
    daily, given = _numbers(_cell_texts(data, cell_low[cell + 2], cell_high[cell + 2]))
    cell, page, streams, daily = cell[given], page[given], streams[given], daily[given]
    return page, _cell_texts(data, cell_low[cell], cell_high[cell]), streams, daily, np.flatnonzero(tags.odd)


def _runs(at: np.ndarray) -> Iterator[tuple[int, int]]:
    i = 0
    while i < len(at) - 1:
        j = max(i + 1, int(np.searchsorted(at, at[i] + CHUNK, "right")) - 1)
        yield i, j
        i = j


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(stamp, html as binary)`` to ``(stamp, text, streams, daily)``, a row per chart row."""
    for batch in batches:
        batch = batch.filter(batch.column(1).is_valid())
        html = batch.column(1).cast(pa.large_binary())
        at = np.frombuffer(html.buffers()[1], np.int64)[html.offset:html.offset + len(html) + 1] if len(html) else np.zeros(1, np.int64)
        data = np.frombuffer(html.buffers()[2] or b"", np.uint8)
        for i, j in _runs(at):
            run = data[at[i]:at[j]]
            try:
                run.tobytes().decode()
                page, text, streams, daily, odd = _run_rows(run, at[i:j + 1] - at[i])
                yield _batch(batch.column(0), page + i, text, streams, daily)
            except UnicodeDecodeError:
                odd = range(j - i)
            found = [(i + k, *r) for k in odd for r in page_rows(html[i + int(k)].as_py().decode("utf-8", "replace"))]
            if found:
                page, text, streams, daily = zip(*found, strict=True)
                yield _batch(batch.column(0), page, pa.array(text, pa.string()), streams, daily)


def _batch(stamp: pa.Array, page, text: pa.Array, streams, daily) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([stamp.take(pa.array(page, pa.int64())), text, pa.array(streams, pa.int64()), pa.array(daily, pa.int64())],
                                      names=["stamp", "text", "streams", "daily"])
