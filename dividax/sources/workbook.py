"""Broker workbook ingest (S-1 .. S-6).

Bulk ingest of many ``.xlsx`` statements: ``binaryFile`` lists and loads the
files, ``mapInArrow`` decodes each workbook (stdlib ``zipfile`` + XML — no
spreadsheet library is needed) into one row with a header -> value map
for each sheet row, and everything after that (placeholder columns, footer rows,
bilingual headers) is plain DataFrame work.  A file that cannot be decoded yields one row with ``_error``
set, so good and bad files split into a clean and a quarantine DataFrame.
"""

from __future__ import annotations

import datetime as dt
import decimal
import io
import re
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree as ET

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import constants as K

CELL_SCHEMA = "path string, account_currency string, sheet_row int, cells map<string,string>, _error string"

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "rel": "http://schemas.openxmlformats.org/package/2006/relationships"}
_REF = re.compile(r"([A-Z]+)(\d+)")
#: English and Polish name of every column that a statement must have.
_HEADER_PAIRS = [(en, pl) for pl, en in K.POLISH_HEADERS.items()]


def _sheet_member(zf: zipfile.ZipFile, sheet_name: str) -> str:
    wb = ET.fromstring(zf.read("xl/workbook.xml"))
    rels = ET.fromstring(zf.read("xl/_rels/workbook.xml.rels"))
    targets = {r.get("Id"): r.get("Target") for r in rels.findall("rel:Relationship", _NS)}
    for s in wb.findall("m:sheets/m:sheet", _NS):
        if s.get("name") == sheet_name:
            target = targets[s.get(f"{{{_NS['r']}}}id")]
            return target.lstrip("/") if target.startswith("/") else "xl/" + target
    raise KeyError(f"Worksheet {sheet_name} does not exist.")


_M = f"{{{_NS['m']}}}"
_C = f"{{{_NS['m']}}}c"
_V = f"{{{_NS['m']}}}v"
_T = f"{{{_NS['m']}}}t"
_SI = f"{{{_NS['m']}}}si"

#: Rows per batch of the row-by-row reader, and sheet bytes per batch of the columnar one (bound the decoder's memory).
ROWS_PER_BATCH = 10_000
BYTES_PER_BATCH = 4_000_000

# Number formats of the file format that show dates or times.
BUILT_IN_DATE_FORMATS = frozenset([14, 15, 16, 17, 18, 19, 20, 21, 22, 27, 28, 29, 30, 31, 32, 33, 34, 35, 36, 45, 46, 47, 50, 51, 52, 53, 54, 55, 56, 57, 58])


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in zf.namelist():
        return []
    out: list[str] = []
    with zf.open("xl/sharedStrings.xml") as fh:
        for _event, el in ET.iterparse(fh, events=("end",)):
            if el.tag == _SI:
                out.append("".join(t.text or "" for t in el.iter(_T)))
                el.clear()
    return out


def _date_styles(zf: zipfile.ZipFile) -> tuple[set[int], dt.datetime]:
    """Indexes of the cell styles that show dates, and the day that serial number 0 stands for."""
    epoch = dt.datetime(1899, 12, 30)
    if re.search(rb'date1904="(1|true)"', zf.read("xl/workbook.xml")):
        epoch = dt.datetime(1904, 1, 1)
    if "xl/styles.xml" not in zf.namelist():
        return set(), epoch
    root = ET.fromstring(zf.read("xl/styles.xml"))
    codes = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter(f"{_M}numFmt")}
    plain = lambda code: re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", code).lower()
    dates = BUILT_IN_DATE_FORMATS | {i for i, code in codes.items() if re.search("[dmyhs]", plain(code))}
    xfs = root.find(f"{_M}cellXfs")
    return {i for i, xf in enumerate(xfs if xfs is not None else ()) if int(xf.get("numFmtId", "0")) in dates}, epoch


def _cell_value(el: ET.Element, shared: list[str], dates: set[int], epoch: dt.datetime) -> str | None:
    """Text of a cell; dates as ISO text, errors and blanks as None."""
    kind = el.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in el.iter(_T))
    v = el.find(_V)
    if v is None or v.text is None or kind == "e":
        return None
    if kind == "s":
        return shared[int(v.text)]
    if kind == "b":
        return "TRUE" if v.text == "1" else "FALSE"
    if kind in (None, "n") and int(el.get("s", "0")) in dates:
        return str(epoch + dt.timedelta(seconds=round(float(v.text) * 86400)))
    return v.text


def _iter_rows(fh, shared: list[str], dates: set[int], epoch: dt.datetime) -> Iterator[tuple[int, dict[str, str]]]:
    """Stream ``(row, {column letters: value})`` of the non-empty rows; a row is dropped from the tree once read,
    so memory does not grow with the sheet."""
    above = None
    for event, el in ET.iterparse(fh, events=("start", "end")):
        if event == "start":
            if el.tag == f"{_M}sheetData":
                above = el
            continue
        if el.tag != f"{_M}row":
            continue
        number, cells = int(el.get("r", "0")), {}
        for c in el.iter(_C):
            m = _REF.fullmatch(c.get("r", ""))
            value = _cell_value(c, shared, dates, epoch) if m else None
            if value is not None:
                number = int(m.group(2))
                cells[m.group(1)] = value
        if above is not None:
            above.clear()
        if cells:
            yield number, cells


#: The plain form of what stands around the texts of a row, as nearly every writer gives it; all else goes to the XML parser.
_PLAIN_ROW = re.compile(rb'(?: spans="[0-9: ]*")?>\s*')
_PLAIN_EMPTY_ROW = re.compile(rb'(?: spans="[0-9: ]*")?(?:/>|></row>)\s*')
_PLAIN_OPEN = re.compile(rb'(?: s="([0-9]{1,6})")?(?: t="([a-zA-Z]+)")?(/>|></c>|><v>|><is><t(?: xml:space="preserve")?>)')
_CLOSE_OF = {b"/>": b"", b"></c>": b"", b"><v>": b"</v></c>"}
_INLINE_CLOSE = b"</t></is></c>"
#: Most forms of ``_PLAIN_OPEN`` that the cells of a piece may have.
_MOST_FORMS = 64
#: Most bytes of a piece: the places in it are 32-bit numbers.
_MOST_BYTES = 2**31 - 128
#: Masks of the first 0 to 8 bytes of a little-endian word.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_PLAIN_HEAD = re.compile(rb'^(?:<\?xml version="1.0"(?: encoding="(?i:utf-8)")?(?: standalone="\w+")?\s*\?>\s*)?<worksheet [^>]*?xmlns="%s"[^>]*>' % _NS["m"].encode())
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))
_OTHER_ENTITY = re.compile(rb"&(?!(?:lt|gt|quot|apos|amp);)")
#: Bytes that XML forbids or changes.
_ODD_BYTES = bytes(set(range(32)) - {9, 10})

#: Cells of whole rows: row numbers, for each row where its cells start and end, the cells' columns (a dictionary) and values (no NULLs).
Cells = tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]


def _flat_cells(rows: list[tuple[int, dict[str, str]]]) -> Cells:
    ends = np.cumsum([0, *(len(cells) for _n, cells in rows)], dtype=np.int64)
    return (np.array([n for n, _cells in rows], dtype=np.int64), ends,
            pa.array([c for _n, cells in rows for c in cells], pa.string()).dictionary_encode(), pa.array([v for _n, cells in rows for v in cells.values()], pa.string()))


def _holds(words: np.ndarray, at: np.ndarray, text: bytes) -> np.ndarray:
    """Whether ``text`` stands at each of the places."""
    same = np.ones(len(at), dtype=bool)
    for i in range(0, len(text), 8):
        part = text[i : i + 8]
        same &= (words[at + i] & _FIRST_BYTES[len(part)]) == np.uint64(int.from_bytes(part, "little"))
    return same


def _plain_cells(piece: bytes, shared: pa.Array, dates: set[int], epoch: dt.datetime) -> Cells | None:
    """The cells of a run of whole rows by column operations on its bytes, or None if any row isn't in the plain form.

    Only the starts of rows and cells are looked up; the markup around a cell's text is compared with few literals there, and
    a text between them holds no markup if the piece has no ``<`` besides those of the literals."""
    if len(piece) > _MOST_BYTES:
        return None
    padded = piece + bytes(64)  # words may be read beyond the end
    data, words = np.frombuffer(padded, np.uint8), np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    if b"]]>" in piece or (data[: len(piece)] < 32).any() and len(piece.translate(None, _ODD_BYTES)) != len(piece):
        return None
    if not piece.isascii():
        piece.decode()  # or an error
        if b"\xef\xbf\xbe" in piece or b"\xef\xbf\xbf" in piece:
            return None
    escaped = b"&" in piece
    if escaped and _OTHER_ENTITY.search(piece):
        return None
    opens = data[: len(piece)] == ord("<")
    row, cell = (np.flatnonzero(opens & (data[1 : len(piece) + 1] == ord(c))) for c in "rc")
    if not len(row) or piece[: row[0]].strip() or not _holds(words, row, b'<row r="').all() or not _holds(words, cell, b'<c r="').all():
        return None
    bounds = np.append(np.searchsorted(cell, row), len(cell))
    counts = np.diff(bounds)
    row_of = np.repeat(np.arange(len(row)), counts)
    after_row = np.append(row[1:], len(piece))

    # the row's number, then the rest of its tag
    number_at = row + len('<row r="')
    digits = data[number_at[:, None] + np.arange(8)]
    n_digits = np.argmin((digits >= ord("0")) & (digits <= ord("9")), axis=1)  # 0: none, or too many
    rest, tag_end = number_at + n_digits + 1, after_row.copy()
    tag_end[counts > 0] = cell[bounds[:-1][counts > 0]]
    if (n_digits == 0).any() or (digits[:, 0] == ord("0")).any() or (data[rest - 1] != ord('"')).any():
        return None
    numbers, markup = np.zeros(len(row), dtype=np.int64), len(row)  # markup: how many < are known
    for k in range(int(n_digits.max())):
        numbers = np.where(n_digits > k, numbers * 10 + digits[:, k] - ord("0"), numbers)
    for i in np.flatnonzero((counts == 0) | (tag_end != rest + 1) | (data[rest] != ord(">"))).tolist():
        text = piece[rest[i] : tag_end[i]]
        if not (_PLAIN_ROW if counts[i] else _PLAIN_EMPTY_ROW).fullmatch(text):
            return None
        markup += text.count(b"<")

    # a cell's reference: one to three letters and its row's number
    ref = cell + len('<c r="')
    letters = [data[ref + k].astype(np.int64) - 64 for k in range(3)]
    is_letter = [(v >= 1) & (v <= 26) for v in letters]
    two = is_letter[0] & is_letter[1]
    three = two & is_letter[2]
    place = np.where(two, letters[0] * 26 + letters[1], letters[0])
    place = np.where(three, place * 26 + letters[2], place)
    ref_number, first = ref + 1 + two + three, _FIRST_BYTES[n_digits + 1]  # with the closing quote
    if not is_letter[0].all() or ((words[ref_number] & first[row_of]) != (words[number_at] & first)[row_of]).any():
        return None
    if ((np.diff(place) <= 0) & (np.diff(row_of) == 0)).any():  # a column twice or out of order
        return None

    # what stands around a cell's text: few forms, each compared once
    text_from, form, forms, left = ref_number + (n_digits + 1)[row_of], np.zeros(len(cell), dtype=np.int64), [], np.arange(len(cell))
    while len(left):
        found = _PLAIN_OPEN.match(piece, text_from[left[0]])
        if not found or len(forms) == _MOST_FORMS:
            return None
        same = _holds(words, text_from[left], found[0])
        form[left[same]] = len(forms)
        forms.append(found)
        left = left[~same]
    text_from += np.array([len(f[0]) for f in forms], dtype=np.int64)[form]

    def trimmed(stop: np.ndarray) -> np.ndarray:
        if not (data[stop - 1] <= 32).any():
            return stop
        signs = np.where(data[: len(piece)] > 32, np.arange(1, len(piece) + 1), 0)
        return np.maximum.accumulate(signs)[stop - 1]

    last = bounds[1:][counts > 0] - 1
    text_to = np.append(cell[1:], len(piece))
    text_to[last] = trimmed(after_row[counts > 0]) - len("</row>")
    if not _holds(words, text_to[last], b"</row>").all():
        return None
    text_to = trimmed(text_to)
    for i, f in enumerate(forms):
        of_it, closing = np.flatnonzero(form == i), _CLOSE_OF.get(f[3], _INLINE_CLOSE)
        text_to[of_it] -= len(closing)
        if not _holds(words, text_to[of_it], closing).all() or not closing and (text_to[of_it] != text_from[of_it]).any():
            return None
        markup += len(of_it) * (1 + f[0].count(b"<") + closing.count(b"<"))
    if (text_to < text_from).any() or markup + len(last) != np.count_nonzero(opens):
        return None

    types = [(f[2] or b"n").decode() for f in forms]
    of_form = lambda test: np.array([test(t, f) for t, f in zip(types, forms)], dtype=bool)[form]
    inline, valued = of_form(lambda t, _f: t == "inlineStr"), of_form(lambda t, f: f[3] == b"><v>" and t not in ("inlineStr", "e"))
    blank = of_form(lambda t, f: t == "inlineStr" and not f[3].startswith(b"><is>"))  # a text cell without text
    filled = inline | valued & (text_to > text_from)
    edges = np.stack([text_from, np.where(blank, text_from, text_to)], axis=1)[filled].ravel()
    value = pa.array([], pa.string())
    if len(edges):  # every other one of the parts between the edges is a text
        parts = pa.Array.from_buffers(pa.string(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), pa.py_buffer(padded)])
        value = parts.take(pa.array(np.arange(0, len(edges), 2)))
    if escaped:
        for entity, char in _ENTITIES:
            value = pc.replace_substring(value, entity, char)
    for kind, change in (("s", lambda v: shared.take(pc.cast(v, pa.int64()))), ("b", lambda v: pc.if_else(pc.equal(v, "1"), "TRUE", "FALSE"))):
        mask = of_form(lambda t, _f: t == kind)[filled]
        if mask.any():
            value = pc.replace_with_mask(value, pa.array(mask), change(value.filter(pa.array(mask))))
    mask = of_form(lambda t, f: t == "n" and int(f[1] or b"0") in dates)[filled]
    if mask.any():
        seconds = np.rint(pc.cast(value.filter(pa.array(mask)), pa.float64()).to_numpy() * 86400)
        low, high = ((d - epoch).total_seconds() for d in (dt.datetime.min, dt.datetime.max))
        if not ((seconds >= low) & (seconds <= high)).all():
            return None
        days = seconds.astype(np.int64) + int((epoch - dt.datetime(1970, 1, 1)).total_seconds())
        value = pc.replace_with_mask(value, pa.array(mask), pc.cast(pa.array(days).cast(pa.timestamp("s")), pa.string()))
    used = np.flatnonzero(np.bincount(place))
    columns = pa.DictionaryArray.from_arrays(pa.array(np.searchsorted(used, place[filled]).astype(np.int32)), pa.array([_letters(c - 1) for c in used.tolist()], pa.string()))
    ends = np.concatenate([[0], np.cumsum(np.bincount(row_of[filled], minlength=len(numbers)))])
    return numbers, ends, columns, value


class _Rest(io.RawIOBase):
    """A stream of bytes at hand followed by what a file still holds."""

    def __init__(self, head: bytes, fh=None):
        self.head, self.fh = io.BytesIO(head), fh

    def read(self, size: int = -1) -> bytes:
        return self.head.read(size) or (self.fh.read(size) if self.fh else b"")


def _iter_cells(fh, shared: list[str], dates: set[int], epoch: dt.datetime) -> Iterator[Cells]:
    """The sheet's cells, streamed in batches of whole rows.

    Runs of rows in the plain form are read by column operations; from the first one that isn't, the XML parser reads
    the rest.  It always reads what stands around the rows, so that a damaged sheet is an error either way."""
    def parsed(stream) -> Iterator[Cells]:
        rows = _iter_rows(stream, shared, dates, epoch)
        out: list[tuple[int, dict[str, str]]] = []
        try:
            for row in rows:
                out.append(row)
                if len(out) >= ROWS_PER_BATCH:
                    yield _flat_cells(out)
                    out = []
        except Exception:
            if out:
                yield _flat_cells(out)
            raise
        if out:
            yield _flat_cells(out)

    opening, closing = b"<sheetData>", b"</sheetData>"
    buffer = fh.read(BYTES_PER_BATCH)
    head, found, buffer = buffer.partition(opening)
    if not found or not _PLAIN_HEAD.match(head) or b"<!" in head or b"<row" in head:
        yield from parsed(_Rest(head + found + buffer, fh))
        return
    strings, head = pa.array(shared, pa.string()), head + opening
    while True:
        end = buffer.find(closing)
        cut = end if end >= 0 else buffer.rfind(b"</row>") + 6
        if end >= 0 or cut >= 6:
            try:
                cells = _plain_cells(buffer[:cut], strings, dates, epoch) if buffer[:cut].strip() else _flat_cells([])
            except (pa.ArrowInvalid, IndexError, ValueError, OverflowError):
                cells = None
            if cells is None:
                break
            yield cells
            buffer = buffer[cut:]
        if end >= 0:
            break
        more = fh.read(BYTES_PER_BATCH)
        if not more:
            break
        buffer += more
    yield from parsed(_Rest(head + buffer, fh))


def _currency_cell() -> tuple[int, str]:
    m = _REF.fullmatch(K.CURRENCY_CELL)
    return int(m.group(2)), m.group(1)


_ROW_SCHEMA = pa.schema([("path", pa.string()), ("account_currency", pa.string()), ("sheet_row", pa.int32()),
                         ("cells", pa.map_(pa.string(), pa.string())), ("_error", pa.string())])


def statement_batches(path: str, content: bytes, sheet_name: str = K.STATEMENT_SHEET) -> Iterator[pa.RecordBatch]:
    """S-2 + S-3 for one workbook, streamed: ``(path, account_currency, sheet_row, {header: value}, None)``
    for every row below the header row (the first row holding ``ID``); cells under an empty header
    are left out.  Every file binds its own header: columns in any order, English or Polish names.
    A sheet without header row, without account currency, with a header twice, or without one of the
    statement's columns in either language is an error.

    A first pass reads only the top of the sheet (up to the header row and the currency cell);
    the second pass streams the data rows."""
    cur_row, cur_col = _currency_cell()
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        member, source = _sheet_member(zf, sheet_name), (_shared_strings(zf), *_date_styles(zf))
        currency, header_row, headers = None, None, {}
        with zf.open(member) as fh:
            for number, cells in _iter_rows(fh, *source):
                if number == cur_row:
                    currency = cells.get(cur_col)
                if header_row is None and K.HEADER_MARKER in cells.values():
                    header_row, headers = number, cells
                if header_row is not None and number >= cur_row:
                    break
        if header_row is None:
            raise ValueError(f"no '{K.HEADER_MARKER}' header row")
        if not (currency or "").strip():
            raise ValueError(f"no account currency in cell {K.CURRENCY_CELL}")
        twice = {h for h in headers.values() if list(headers.values()).count(h) > 1}
        if twice:
            raise ValueError(f"header more than once: {', '.join(sorted(twice))}")
        missing = [en for en, pl in _HEADER_PAIRS if en not in headers.values() and pl not in headers.values()]
        if missing:
            raise ValueError(f"column missing: {', '.join(missing)}")
        letters, names = pa.array(list(headers), pa.string()), pa.array(list(headers.values()), pa.string())
        with zf.open(member) as fh:
            for numbers, ends, columns, values in _iter_cells(fh, *source):
                row_of = np.repeat(np.arange(len(numbers)), np.diff(ends))
                header = pc.index_in(columns.dictionary, letters).take(columns.indices)
                kept = pc.is_valid(header).to_numpy(zero_copy_only=False) & (numbers > header_row)[row_of]
                counts = np.bincount(row_of[kept], minlength=len(numbers))
                named, mask = counts > 0, pa.array(kept)
                n = int(named.sum())
                if n:
                    ends = pa.array(np.concatenate([[0], np.cumsum(counts[named])]), pa.int32())
                    cells = pa.MapArray.from_arrays(ends, names.take(header.filter(mask)), values.filter(mask))
                    yield pa.RecordBatch.from_arrays([pa.repeat(path, n), pa.repeat(currency, n), pa.array(numbers[named], pa.int32()), cells,
                                                      pa.nulls(n, pa.string())], schema=_ROW_SCHEMA)


def statement_rows(path: str, content: bytes, sheet_name: str = K.STATEMENT_SHEET) -> Iterator[tuple]:
    """The rows of :func:`statement_batches` as tuples, the cells as a dictionary."""
    for batch in statement_batches(path, content, sheet_name):
        for row in batch.to_pylist():
            yield row["path"], row["account_currency"], row["sheet_row"], dict(row["cells"]), row["_error"]


def _decode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            try:
                yield from statement_batches(path, content.as_py())
            except Exception as exc:  # unreadable / corrupt / wrong sheet / no header: quarantined, never raised
                yield pa.RecordBatch.from_pylist([{"path": path, "_error": f"{type(exc).__name__}: {exc}"}], schema=_ROW_SCHEMA)


def read_workbook_cells(spark: SparkSession, path_glob: str) -> DataFrame:
    """S-1 + S-6 + S-7: cells of every workbook matching ``path_glob`` (missing files ignored)."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx")
        .option("ignoreMissingFiles", "true").load(path_glob).select("path", "content")
    )
    return decode_cells(files)


def decode_cells(files: DataFrame) -> DataFrame:
    """``(path, content)`` rows -> header-keyed rows; each task decodes the workbooks of its partition."""
    return files.mapInArrow(_decode_batches, CELL_SCHEMA)


def cells_to_statements(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S-4 + S-5 + P-2: header-keyed rows -> (statement rows, quarantine).

    Each sheet row arrives as one row with a ``header -> value`` map, so nothing is shuffled;
    footer rows (any cell containing ``Total``) are dropped; English or Polish headers resolve to
    the English statement columns; placeholder columns are dropped and every other
    column stays available in ``cells``.  ``acct`` is the statement file."""
    bad = cells.where(F.col("_error").isNotNull()).select("path", "_error")
    rows = cells.where(F.col("_error").isNull())
    # looked up in the map as read: no statement column is a placeholder
    entries, named = F.map_entries("cells"), lambda e: ~e["key"].isin(*K.PLACEHOLDER_COLUMNS)
    # the lambdas cost most of a row's time, so they only run where one look at all texts, or at the ID, doesn't settle it
    maybe = F.array_join(F.map_values("cells"), "\n", K.FOOTER_MARKER).contains(K.FOOTER_MARKER)
    footer = maybe & F.exists(F.map_values("cells"), lambda v: v.contains(K.FOOTER_MARKER)) & F.exists(entries, lambda e: named(e) & e["value"].contains(K.FOOTER_MARKER))
    filled = F.col("cells")[K.HEADER_MARKER].isNotNull() | F.exists(F.map_keys("cells"), lambda k: ~k.isin(*K.PLACEHOLDER_COLUMNS))
    rows = rows.where(filled & ~footer)
    polish_of = {en: pl for pl, en in K.POLISH_HEADERS.items()}
    m = F.col("cells")
    cols = [F.col("path").alias("acct"), "account_currency", "sheet_row", m[K.HEADER_MARKER].alias(K.HEADER_MARKER)]
    cols += [F.coalesce(m[en], m[polish_of[en]]).alias(en) for en in K.CANONICAL_HEADERS]
    kept = F.map_filter("cells", lambda k, v: ~k.isin(*K.PLACEHOLDER_COLUMNS))
    return rows.select(*cols, kept.alias("cells")), bad


#: The day of serial number 0, and a style sheet whose style 1 shows date and time (format 22).
_SERIAL_ZERO = dt.datetime(1899, 12, 30)
_STYLES = ('<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="%s"><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>' % _NS["m"])


def drop_footer_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """S-5: drop rows in which any of ``columns`` contains ``Total`` (case-sensitive), NULL-safe."""
    cells = F.array(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in columns])
    return df.where(~F.exists(cells, lambda v: v.contains(K.FOOTER_MARKER)))


def _letters(c: int) -> str:
    letters = ""
    c += 1
    while c:
        c, rem = divmod(c - 1, 26)
        letters = chr(65 + rem) + letters
    return letters


def _row_xml(r: int, row: list) -> str:
    def cell(c: int, v) -> str:
        if v is None:
            return ""
        if isinstance(v, (int, float, decimal.Decimal)) and not isinstance(v, bool):
            return f'<c r="{_letters(c)}{r}"><v>{v}</v></c>'
        if isinstance(v, dt.datetime):
            return f'<c r="{_letters(c)}{r}" s="1"><v>{(v - _SERIAL_ZERO) / dt.timedelta(days=1)!r}</v></c>'
        s = str(v).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
        return f'<c r="{_letters(c)}{r}" t="inlineStr"><is><t>{s}</t></is></c>'

    return f'<row r="{r}">' + "".join(cell(j, v) for j, v in enumerate(row)) + "</row>"


def _rows_xml(first: int, start: int, columns: list[pa.ChunkedArray]) -> list[memoryview]:
    """Rows from number ``first`` on, their cells from column ``start`` on, as :func:`_row_xml` writes them one by one (pieces of text)."""
    n = len(columns[0])
    number = pc.cast(pa.array(np.arange(first, first + n)), pa.string())
    parts: list = ['<row r="', number, '">']  # texts of all rows, with the literals between them

    def add(literal: str, *more) -> None:
        parts[-1:] = [parts[-1] + literal] if isinstance(parts[-1], str) else [parts[-1], literal]
        parts.extend(more)

    for j, column in enumerate(columns, start=start):
        values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        opening, closing = '"><v>', "</v></c>"
        if pa.types.is_timestamp(values.type):
            micros = values.cast(pa.timestamp("us"), safe=False).cast(pa.int64()).to_numpy(zero_copy_only=False)
            since = (dt.datetime(1970, 1, 1) - _SERIAL_ZERO) // dt.timedelta(microseconds=1)
            opening, text = '" s="1"><v>', pc.cast(pa.array((micros + since) / 86_400e6, mask=pc.is_null(values).to_numpy(zero_copy_only=False)), pa.string())
        elif pa.types.is_floating(values.type):
            text = pc.cast(pc.if_else(pc.is_nan(values), None, values), pa.string())
        elif pa.types.is_integer(values.type) or pa.types.is_decimal(values.type):
            text = pc.cast(values, pa.string())
        else:
            opening, text, closing = '" t="inlineStr"><is><t>', pc.cast(values, pa.string()), "</t></is></c>"
            for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
                if any((np.frombuffer(buf, np.uint8) == ord(char)).any() for buf in text.buffers()[2:] if buf):
                    text = pc.replace_substring(text, char, entity)
        opening = f'<c r="{_letters(j)}', number, opening
        if text.null_count:  # NULL: no cell
            add("", pc.coalesce(pc.binary_join_element_wise(*opening, text, closing, ""), ""))
        else:
            add(opening[0], number, opening[2], text, closing)
    add("</row>")
    rows = pc.binary_join_element_wise(*parts, "")
    return [memoryview(buf)[_text_span(rows)] for buf in rows.buffers()[2:]]


def _text_span(texts: pa.StringArray) -> slice:
    """Where the text of an array's values lies in its buffer."""
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return slice(int(bounds[0]), int(bounds[-1]))


def _package(body: list[bytes], sheet_name: str, level: int | None = None) -> bytes:
    """The ``.xlsx`` file around the pieces of a sheet's rows."""
    sheet = b"".join([b'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="%s"><sheetData>' % _NS["m"].encode(), *body, b"</sheetData></worksheet>"])
    workbook = ('<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="%s" xmlns:r="%s"><sheets>'
                '<sheet name="%s" sheetId="1" r:id="rId1"/></sheets></workbook>' % (_NS["m"], _NS["r"], sheet_name))
    rels = ('<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="%s"><Relationship Id="rId1" '
            'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
            'Target="worksheets/sheet1.xml"/></Relationships>' % _NS["rel"])
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED, compresslevel=level) as zf:
        zf.writestr("xl/workbook.xml", workbook)
        zf.writestr("xl/_rels/workbook.xml.rels", rels)
        zf.writestr("xl/worksheets/sheet1.xml", sheet)
        if b' s="1"' in sheet:
            zf.writestr("xl/styles.xml", _STYLES)
    return buf.getvalue()


def workbook_bytes(rows: list[list], sheet_name: str = K.STATEMENT_SHEET) -> bytes:
    """Minimal ``.xlsx`` encoder (inline strings, numbers, dates as styled serial numbers) used to build test inputs."""
    return _package([_row_xml(i, row).encode() for i, row in enumerate(rows, start=1)], sheet_name)


def statement_bytes(top: list[list], body: pa.Table, footer: list) -> bytes:
    """A statement workbook: ``top`` (title block and header), the columns of ``body`` from column B on, a footer row."""
    rows = [_row_xml(i, row) for i, row in enumerate(top, start=1)]
    last = _row_xml(len(top) + body.num_rows + 1, footer)
    return _package(["".join(rows).encode(), *_rows_xml(len(top) + 1, 1, body.columns), last.encode()], K.STATEMENT_SHEET, level=1)


def write_workbook(path: str, rows: list[list], sheet_name: str = K.STATEMENT_SHEET) -> None:
    """Write one workbook to a local path (tests)."""
    with open(path, "wb") as f:
        f.write(workbook_bytes(rows, sheet_name))


#: FIXED VALUE: statement rows per generated workbook chunk (bounds one task's file).
ROWS_PER_WORKBOOK = 50_000
_SHEET_COLUMNS = ("ID", "Type", "Time", "Comment", "Symbol", "Amount")


def _chunks(stmt: DataFrame) -> DataFrame:
    """Statement rows with ``year``, ``chunk`` and the account's ``first_year``: chunks are hash buckets sized from the
    row count of their account and year, so that files are few and none grows with the data."""
    keyed = stmt.withColumn("year", F.year("Time"))
    sizes = keyed.groupBy("acct", "year").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_WORKBOOK).alias("buckets"))
    first = F.min("year").over(Window.partitionBy("acct"))
    sizes = sizes.select(F.col("acct").alias("_acct"), F.col("year").alias("_year"), "buckets", first.alias("first_year"))  # one row per account and year
    same = F.col("acct").eqNullSafe(F.col("_acct")) & F.col("year").eqNullSafe(F.col("_year"))
    return keyed.join(F.broadcast(sizes), same).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("buckets"))).drop("_acct", "_year", "buckets")


def statement_workbooks(stmt: DataFrame) -> DataFrame:
    """Encode statement rows as broker workbooks: ``(path, content)`` like ``binaryFile``.

    One workbook per (account, year, hash chunk), with the account currency in F6,
    a title block, an ``ID`` header row between empty placeholder columns, the rows
    and a ``Total`` footer.  Chunks are hash buckets sized from the row count, so a
    hot account cannot put an unbounded number of rows into one workbook or task."""
    rows = _chunks(stmt).select(
        F.col("acct").cast("string").alias("acct"), "account_currency", "year", "chunk",
        F.col("id").alias("ID"), "Type", F.date_format("Time", "dd.MM.yyyy HH:mm:ss").alias("Time"),
        "Comment", "Symbol", F.col("Amount").cast("string").alias("Amount"),
    )

    def encode_group(table: pa.Table) -> pa.Table:
        acct, currency, year, chunk = (table[c][0].as_py() for c in ("acct", "account_currency", "year", "chunk"))
        top = [[None] * 8 for _ in range(9)]
        top[5][5] = currency
        top[1][1] = "Cash operation history"
        header = [None, *_SHEET_COLUMNS, None]
        footer = [None, None, None, None, None, "Total", str(table.num_rows), None]
        content = statement_bytes([*top, header], table.select(_SHEET_COLUMNS), footer)
        return pa.table({"path": [f"stmt-{acct}-{year}-{chunk}.xlsx"], "content": pa.array([content], pa.binary())})

    return rows.groupBy("acct", "year", "chunk").applyInArrow(encode_group, "path string, content binary")


#: FIXED VALUES: damage of a written fleet, told by a file's place among its account's years.
FLEET_DAMAGE = ("corrupt", "no_currency", "header_twice")


#: FIXED VALUES: layouts of a mixed fleet by year modulo 4: the columns in their order, under the names they have there.
MIXED_LAYOUTS = (
    ("ID", "Type", "Time", "Comment", "Symbol", "Amount"),
    ("ID", "Typ", "Czas", "Komentarz", "Ticker", "Kwota"),
    ("Amount", "Symbol", "ID", "Czas", "Komentarz", "Type"),
    ("ID", "Type", "Time", "Comment", "Symbol"),
)


def write_statement_fleet(stmt: DataFrame, folder: str, mixed: bool = False) -> DataFrame:
    """Write statement rows as workbooks below ``folder``; one row per file ``(path, rows)``.

    Cells are typed as a broker's export types them: times are styled serial numbers, amounts
    numbers.  Files are those of :func:`statement_workbooks`; the first year of account
    ``i`` (for i = 0, 1, 2) is damaged by ``FLEET_DAMAGE[i]``: cut short, without currency cell, or
    with a header twice.  A ``mixed`` fleet's files have the layout of their year (``MIXED_LAYOUTS``):
    English, Polish, other order in both languages, no amounts.  Each task writes its files itself, by the folder's URI (any file system that
    Arrow opens), under names that a repeated task writes again; nothing goes through the driver."""
    rows = _chunks(stmt.where(F.col("acct").isNotNull())).select(
        "acct", "account_currency", "year", "chunk", "first_year",
        F.col("id").alias("ID"), "Type", F.col("Time").cast("timestamp_ntz").alias("Time"), "Comment", "Symbol", "Amount",
    )

    def write_group(table: pa.Table) -> pa.Table:
        acct, currency, year, chunk, first_year = (table[c][0].as_py() for c in ("acct", "account_currency", "year", "chunk", "first_year"))
        damage = FLEET_DAMAGE[acct] if year == first_year and acct < len(FLEET_DAMAGE) else None
        top = [[None] * 9 for _ in range(9)]
        top[5][5] = None if damage == "no_currency" else currency
        top[1][1] = "Cash operation history"
        names = MIXED_LAYOUTS[year % 4] if mixed else _SHEET_COLUMNS
        header = [None, *names, names[-1] if damage == "header_twice" else None, None]
        footer = [None, None, None, None, None, "Total", table.num_rows, None, None]
        content = statement_bytes([*top, header], table.select([K.POLISH_HEADERS.get(n, n) for n in names]), footer)
        path = f"{folder.rstrip('/')}/stmt-{acct}-{year}-{chunk}.xlsx"
        write_bytes(path, content[: len(content) // 2] if damage == "corrupt" else content)
        return pa.table({"path": [path], "rows": [table.num_rows]})

    return rows.groupBy("acct", "year", "chunk").applyInArrow(write_group, "path string, rows long")


def write_bytes(uri: str, content: bytes) -> None:
    """Write a file by URI or local path, replacing it whole (written aside, then moved)."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    aside = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(aside) as out:
        out.write(content)
    store.move(aside, path)


def fleet_file(path: str) -> tuple[Column, Column]:
    """(account, year) columns of a fleet file's name."""
    name = F.substring_index(path, "/stmt-", -1)  # per row: no pattern
    return F.substring_index(name, "-", 1).cast("int").alias("acct"), F.substring_index(F.substring_index(name, "-", 2), "-", -1).cast("int").alias("year")


def reject_reason(error: str) -> Column:
    """Kind of a rejected file from the reader's message: one of ``FLEET_DAMAGE``, ``no_header``, ``column_missing`` or ``unreadable``."""
    e = F.col(error)
    return (F.when(e.contains("no account currency"), "no_currency").when(e.contains("header more than once"), "header_twice")
            .when(e.contains("header row"), "no_header").when(e.contains("column missing"), "column_missing").when(e.startswith("BadZipFile"), "corrupt").otherwise("unreadable"))
