"""Readers (and matching writers) for the department file formats.

* CSV with delimiter fallback: ',' then TAB then a sniffed delimiter, looked for
  outside quotes in the header. A field may hold line breaks, delimiters and
  doubled quotes. A line begins inside a field if an odd number of quotes lie
  before it in the file: each split counts its quotes, the counts are summed in
  file order, and every split then knows how it begins. Fields with quotes must
  be quoted; a record that is not well formed is a bad one.
* JSON in records form (JSON lines or an array) or pandas' default column
  form ``{"col": {"0": v, ...}, ...}``, told apart by how the file begins. A
  column document is cut at its commas and read as a stream of cells, so its
  size and layout don't matter; the rows of a document of some megabytes are put
  together where it is read, those of a larger one by an aggregate.
* HTML: pages end at ``</html>`` in any case; the first ``<table>`` of a page is read
  by a tag-state parser and named by that page's own header cells.

Column names are metadata: only distinct header names reach the driver. Bad
records are left out of the rows and can be had from the ``bad_*`` functions as
(file, reason, record).
"""

from __future__ import annotations

import csv
import json
import re
import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.session import run_folder
from quillmart.sources.splits import HEAD, MIDDLE, TAIL, WHOLE, joined_fragments, map_splits, pieces, texts

SNIFF_CANDIDATES = [";", "|", ":"]
BAD = "file string, reason string, record string"


# ------------------------------------------------------------------- CSV

def choose_delimiter(header: str) -> str:
    """',' if it splits the header into >1 field, else TAB, else the most
    frequent candidate (';', '|', ':'), else ','; quoted parts don't count."""
    bare = re.sub(r'"(?:[^"]|"")*"', "", header)
    for sep in (",", "\t"):
        if sep in bare:
            return sep
    counts = Counter({c: bare.count(c) for c in SNIFF_CANDIDATES})
    best, n = counts.most_common(1)[0]
    return best if n > 0 else ","


def csv_fields(record: str, sep: str) -> list[str | None]:
    """The fields of a record; an empty one is None."""
    csv.field_size_limit(sys.maxsize)
    fields = next(csv.reader([record], delimiter=sep, strict=True), [])
    return [f if f != "" else None for f in fields]


class _Quotes:
    """Per split: whether its number of quotes is odd, and, in the first split
    of a file, the header record and whether it ends there."""

    def __init__(self, file: str, block: int):
        self.file, self.block, self.odd = file, block, 0
        self.header: list[str] | None = [] if block == 0 else None
        self.done = block != 0

    def piece(self, value: str) -> Iterator[tuple]:
        self.odd ^= value.count('"') & 1
        if not self.done and (self.header or value.strip()):
            self.header.append(value)
            self.done = not self.odd
        return iter(())

    def end(self) -> Iterator[tuple]:
        yield self.file, self.block, bool(self.odd), "\n".join(self.header).rstrip("\r") if self.header else None, self.done


class _Records:
    """(kind, text) of a split's records, the header left out, and of the
    fragments at its ends."""

    def __init__(self, file: str, block: int, inside: bool):
        self.file, self.block, self.lines, self.odd = file, block, [], inside
        self.crossing, self.header = inside, block == 0

    def piece(self, value: str) -> Iterator[tuple]:
        if not self.lines and not self.odd and not value.strip():
            return  # blank lines are no records
        self.lines.append(value)
        self.odd ^= value.count('"') & 1 == 1
        if not self.odd:
            text, kind = "\n".join(self.lines).rstrip("\r"), HEAD if self.crossing else WHOLE
            self.lines, self.crossing = [], False
            if self.header:
                self.header = False
            else:
                yield self.file, self.block, kind, text

    def end(self) -> Iterator[tuple]:
        if self.lines:
            yield self.file, self.block, MIDDLE if self.crossing else TAIL, "\n".join(self.lines)


def csv_layout(lines: DataFrame) -> tuple[set[tuple[str, int]], dict[str, str], set[str]]:
    """The splits that begin inside a field, each file's header, and the files
    whose header goes on beyond their first split."""
    found = map_splits(lines, _Quotes, "file string, block long, odd boolean, header string, whole boolean").collect()
    inside, headers, cut, odd, last = set(), {}, set(), False, None
    for r in sorted(found, key=lambda r: (r["file"], r["block"])):
        if r["file"] != last:
            odd, last = False, r["file"]
        if odd:
            inside.add((r["file"], r["block"]))
        odd ^= r["odd"]
        if r["header"] is not None:
            headers[r["file"]] = r["header"]
            if not r["whole"]:
                cut.add(r["file"])
    return inside, headers, cut


def csv_records(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, str]]:
    """(file, text) of every record below the headers, and each file's header."""
    lines = pieces(spark, path, "\n")
    inside, headers, cut = csv_layout(lines)
    parts = map_splits(lines, lambda file, block: _Records(file, block, (file, block) in inside),
                       "file string, block long, kind string, text string")
    whole = parts.where(F.col("kind") == WHOLE).select("file", "text")
    crossing = joined_fragments(parts.where(F.col("kind") != WHOLE), "\n").withColumn("text", F.rtrim("text", F.lit("\r")))
    if cut:  # their headers cross splits themselves
        first = (F.col("block") == 0) & F.col("file").isin(*cut)
        headers |= {r["file"]: r["text"] for r in crossing.where(first).collect()}
        crossing = crossing.where(~first)
    return whole.unionByName(crossing.select("file", "text")), headers


def _csv_rows(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """(file, reason, record, fields): the fields in the order of all names."""
    records, headers = csv_records(spark, path)
    names_of = {}
    for header in dict.fromkeys(headers[f] for f in sorted(headers)):
        sep = choose_delimiter(header)
        seen: Counter = Counter()
        names = []
        for i, name in enumerate(csv_fields(header, sep)):
            name = name or f"Unnamed: {i}"
            names.append(f"{name}.{seen[name]}" if seen[name] else name)
            seen[name] += 1
        names_of[header] = sep, names
    columns = list(dict.fromkeys(n for _, names in names_of.values() for n in names))
    layouts = {h: (sep, [names.index(c) if c in names else None for c in columns], len(names)) for h, (sep, names) in names_of.items()}

    class Parse:
        def __init__(self, file: str, block: int):
            self.file, self.layout = file, layouts.get(headers.get(file, ""))

        def piece(self, value: str) -> Iterator[tuple]:
            if self.layout is None:
                yield self.file, "no header", value, None
                return
            sep, places, n = self.layout
            try:
                fields = csv_fields(value, sep)
            except csv.Error as e:
                yield self.file, str(e), value, None
                return
            if len(fields) > n:
                yield self.file, "too many fields", value, None
            else:
                fields += [None] * (n - len(fields))
                yield self.file, None, None, [fields[p] if p is not None else None for p in places]

        def end(self) -> Iterator[tuple]:
            return iter(())

    found = records.select("file", F.lit(0).cast("long").alias("block"), F.col("text").alias("value"))
    return map_splits(found, Parse, BAD + ", fields array<string>"), columns


def read_csv_fallback(spark: SparkSession, path: str) -> DataFrame:
    """The well-formed records; each file's header names its fields, a column
    that a file lacks and a field that a record lacks are NULL."""
    rows, columns = _csv_rows(spark, path)
    return rows.where("reason IS NULL").select(*[F.col("fields")[i].alias(c) for i, c in enumerate(columns)])


def bad_csv(spark: SparkSession, path: str) -> DataFrame:
    """Records with more fields than the header, or with misplaced quotes."""
    return _csv_rows(spark, path)[0].where("reason IS NOT NULL").drop("fields")


def write_delimited(df: DataFrame, path: str, sep: str) -> None:
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
     .option("quote", '"').option("escape", '"').csv(path))


# ------------------------------------------------------------------ JSON

def column_docs(df: DataFrame, chunk: str, index: str, columns: Sequence[str], pretty: bool = False) -> DataFrame:
    """One pandas-style column-oriented JSON document per chunk, on one line or
    pretty-printed. The chunk column must bound the rows per chunk (e.g. key
    div 1000)."""
    entries = [F.map_from_entries(F.collect_list(F.struct(F.col(index).cast("string"),
                                                          F.col(c).cast("string")))).alias(c)
               for c in columns]
    return df.groupBy(chunk).agg(
        F.to_json(F.struct(*entries), {"pretty": str(pretty).lower()}).alias("value")).select("value")


_MARKS = re.compile(r"[{}\[\]:,]|[^\s{}\[\]:,]+")
_QUOTED = re.compile(r'"(?:[^"\\]++|\\.)*+"', re.DOTALL)


def _runs_of_cells() -> dict[str, re.Pattern]:
    """By state, what takes as many flat cells as follow one another, or the value
    of a cell; what is not written as JSON demands it does not match."""
    string, blank = r'"(?:[^"\\]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"', r"[ \t\n\r]*+"
    number = r"-?(?:0|[1-9][0-9]{0,99})(?:\.[0-9]{1,99})?+(?:[eE][-+]?[0-9]{1,9})?+"
    value = rf"{blank}:{blank}(?:{string}|(?:null|true|false|{number})(?=[ \t\n\r,}}]))"
    run = rf"({string}{value}(?:{blank},{blank}{string}{value})*+)"
    first = re.compile(blank + run)
    return {"first index": first, "index": first, "index:": re.compile(f"({value})"), "after value": re.compile(f"{blank},{blank}{run}")}


_RUNS = _runs_of_cells()
_DECODE = json.JSONDecoder(object_pairs_hook=list, parse_int=str, parse_float=str, strict=False).decode
#: Characters of a document that a task holds before its cells go on as they are, and cells of a block.
HELD, BLOCK = 8 << 20, 16384
BLOCKS = "file string, doc long, whole boolean, cols array<string>, idx array<string>, vals array<array<string>>, reason string"
PACKED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst")


class CellStream:
    """Blocks of rows of the column documents of one file, from its text cut at
    some of its commas. Cells in a row are taken together where they are flat;
    all else goes by marks and strings. A document of up to ``HELD`` characters
    gives whole rows; of a larger one, parts of single columns are handed on,
    and an aggregate puts the rows together. A column without cells is named
    too. The stream ends at the first thing that is no column document, which
    gives a reason; what precedes it counts.

    ``state``: what may come next ("document", "column", "index", ":" ..)."""

    def __init__(self, file: str, size: int = -1):
        self.file, self.doc, self.idx = file, -1, None
        self.state, self.failed = "document", False
        self.text, self.waiting, self.enough = [], 0, 0  # not yet taken, its length, and the length to wait for
        self.left = size if not file.endswith(PACKED) else -1  # bytes of the file beyond the pieces
        self.nested, self.raw = 0, []  # of a value that is itself an object or a list
        self.columns, self.held, self.whole = [], 0, True  # of the document: (name, indexes, values)

    def piece(self, value: str) -> Iterator[tuple]:
        if self.failed:
            return
        self.left -= len(value.encode()) + 1
        self.text.append(value)
        self.waiting += len(value)
        if self.waiting >= self.enough:
            yield from self._take(",".join(self.text))

    def end(self) -> Iterator[tuple]:
        if self.failed:
            return
        if self.left in (0, 3):  # a comma at the very end (of a file with a mark of byte order) ends no piece
            self.text.append("")
        yield from self._take(",".join(self.text))
        if self.failed:
            return
        outside, _, string = self.text[0].partition('"')
        open_string = string.endswith('"') or (len(string) - len(string.rstrip("\\"))) % 2 == 1
        try:
            yield from self._marks(outside)
            if string and not open_string:
                yield from self._string(string)
            if open_string or self.nested or self.state != "document":
                raise ValueError("the document has no end")
        except ValueError as e:
            yield from self._fault(str(e))

    def _take(self, text: str) -> Iterator[tuple]:
        """Up to the last whole string; the rest waits for as much text again."""
        at = 0
        try:
            while True:
                run = _RUNS[self.state].match(text, at) if self.state in _RUNS and not self.nested else None
                if run:
                    at = run.end()
                    yield from self._run(run[1])
                    continue
                quote = text.find('"', at)
                string = _QUOTED.match(text, quote) if quote >= 0 else None
                if not string:
                    break
                yield from self._marks(text[at:quote])
                at = string.end()
                yield from self._string(text[quote + 1:at - 1])
        except ValueError as e:
            yield from self._fault(str(e))
        self.text, self.waiting, self.enough = [text[at:]], len(text) - at, 2 * (len(text) - at)

    def _fault(self, reason: str) -> Iterator[tuple]:
        self.failed = True
        yield from self._rows()
        yield self.file, self.doc, None, None, None, None, reason

    def _rows(self, ended: bool = True) -> Iterator[tuple]:
        """What is held of the document, which ends here or goes on."""
        if self.whole and ended:
            found = [merged(self.columns)] if self.columns else []
        else:
            self.whole = False
            found = [([name], idx, [values]) for name, idx, values in self.columns]
        for names, idx, values in found:
            step = max(1, BLOCK // len(names))
            for k in range(0, len(idx) or 1, step):
                yield self.file, self.doc, self.whole, names, idx[k:k + step], [v[k:k + step] for v in values], None
        self.columns, self.held = [] if ended else [(self.columns[-1][0], [], [])], 0

    def _cells(self, idx: Sequence[str], values: Sequence[str | None], length: int) -> Iterator[tuple]:
        self.columns[-1][1].extend(idx)
        self.columns[-1][2].extend(values)
        self.state = "after value"
        self.held += length
        if self.held > HELD:
            yield from self._rows(ended=False)

    def _run(self, text: str) -> Iterator[tuple]:
        idx, values = zip(*_DECODE(f'{{""{text}}}' if self.state == "index:" else f"{{{text}}}"))
        if self.state == "index:":
            idx = [self.idx]
        if "true" in text or "false" in text:
            values = [str(v).lower() if isinstance(v, bool) else v for v in values]
        return self._cells(idx, values, len(text))

    def _string(self, text: str) -> Iterator[tuple]:
        if self.nested:
            self.raw.append(f'"{text}"')
            return
        value = json.loads(f'"{text}"', strict=False)
        if self.state in ("column", "first column"):
            self.state = "column:"
            self.columns.append((value, [], []))
        elif self.state in ("index", "first index"):
            self.idx, self.state = value, "index:"
        elif self.state == "value":
            yield from self._cells([self.idx], [value], len(self.idx) + len(text))
        else:
            raise ValueError(f"unexpected string at {self.state}")

    def _marks(self, text: str) -> Iterator[tuple]:
        for mark in _MARKS.findall(text):
            yield from self._mark(mark)

    def _mark(self, mark: str) -> Iterator[tuple]:
        if self.nested or (self.state == "value" and mark in "{["):
            self.raw.append(mark)
            self.nested += (mark in "{[") - (mark in "}]")
            if not self.nested:
                raw, self.raw = "".join(self.raw), []
                yield from self._cells([self.idx], [raw], len(self.idx) + len(raw))
            return
        step = {("document", "{"): "first column", ("column:", ":"): "rows", ("rows", "{"): "first index", ("index:", ":"): "value",
                ("after value", ","): "index", ("after value", "}"): "after rows", ("first index", "}"): "after rows",
                ("after rows", ","): "column", ("after rows", "}"): "document", ("first column", "}"): "document"}.get((self.state, mark))
        if step:
            if self.state == "document":
                self.doc, self.whole = self.doc + 1, True
            self.state = step
            if step == "document":
                yield from self._rows()
        elif self.state == "value" and mark not in "]}:,":
            json.loads(mark)
            yield from self._cells([self.idx], [None if mark == "null" else mark], len(self.idx) + len(mark))
        else:
            raise ValueError(f"unexpected {mark} at {self.state}")


def merged(columns: list[tuple[str, list, list]]) -> tuple[list[str], list[str], list[list]]:
    """Names, indexes and the values of each name by index, from columns with
    their cells in any order; of several values of a cell, the greatest."""
    names, first = list(dict.fromkeys(name for name, _, _ in columns)), columns[0][1]
    if len(names) == len(columns) and all(idx == first for _, idx, _ in columns) and len(set(first)) == len(first):
        return names, first, [values for _, _, values in columns]
    place: dict[str, int] = {}
    for _, idx, _ in columns:
        for i in idx:
            place.setdefault(i, len(place))
    out: dict[str, list] = {name: [None] * len(place) for name in names}
    for name, idx, values in columns:
        mine = out[name]
        for i, v in zip(idx, values):
            at = place[i]
            if v is not None and (mine[at] is None or v > mine[at]):
                mine[at] = v
    return names, list(place), list(out.values())


def json_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of rows of the column documents of a path: the text of a file
    streams in order through one task, which holds one document, or of a large
    one a part (a document cannot be understood from its middle)."""
    in_order = texts(spark, path, ",").repartition("file").sortWithinPartitions("file", "block", "at")
    whole_files = in_order.withColumn("block", F.col("size"))  # one reader per file, which is told the size
    return map_splits(whole_files, CellStream, BLOCKS, at_once=16)


def read_json_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The rows of column-oriented documents (all text, plus the row index
    ``unnamed_0`` that the index keys carry). What precedes the first fault of a
    file is read. The text is read once: its blocks are written to the shared
    folder, from where the names and then the rows are taken."""
    written = run_folder(spark, "cells") + "/blocks"
    json_blocks(spark, path).where("reason IS NULL").drop("reason").write.parquet(written)
    blocks = spark.read.schema(BLOCKS).parquet(written)
    found = blocks.select(F.explode("cols").alias("col"), "whole").distinct().collect()
    if columns is None:
        columns = sorted({r["col"] for r in found})
    place = [F.array_position("cols", c) for c in columns]
    none = F.array().cast("array<string>")
    values = [F.coalesce(F.when(at > 0, F.get("vals", (at - 1).cast("int"))), none) for at in place]
    rows = blocks.where("whole").select(F.inline(F.arrays_zip("idx", *values)))
    if not all(r["whole"] for r in found):
        cells = blocks.where("NOT whole").select("file", "doc", F.col("cols")[0], F.inline(F.arrays_zip("idx", F.col("vals")[0])))
        cells = cells.toDF("file", "doc", "col", "idx", "v").groupBy("file", "doc", "idx").agg(
            *[F.max(F.when(F.col("col") == c, F.col("v"))) for c in columns])
        rows = rows.union(cells.drop("file", "doc"))
    return rows.toDF("unnamed_0", *columns)


def json_form(start: str) -> str:
    """'columns', 'array' or 'lines', from the beginning of a JSON file."""
    if re.match(r'\s*\{\s*"(?:[^"\\]|\\.)*"\s*:\s*\{\s*("|\})', start):
        return "columns"
    return "array" if start.lstrip().startswith("[") else "lines"


def _json_form_of(spark: SparkSession, path: str) -> str:
    """From the first pieces between quotes, whatever the file's layout."""
    first = spark.read.option("lineSep", '"').text(path).where("trim(value) != ''").limit(8).collect()
    return json_form('"'.join(r[0] for r in first) + '"')


def read_json_any(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A JSON export in any of the three forms; records that are no JSON are
    left out."""
    form = _json_form_of(spark, path)
    if form == "columns":
        return read_json_columns(spark, path, columns)
    reader = spark.read.option("multiLine", form == "array").option("primitivesAsString", True)
    return reader.option("mode", "DROPMALFORMED").json(path)


def bad_json(spark: SparkSession, path: str) -> DataFrame:
    form = _json_form_of(spark, path)
    if form == "columns":
        return json_blocks(spark, path).where("reason IS NOT NULL").select("file", "reason", F.lit(None).cast("string").alias("record"))
    rows = spark.read.option("multiLine", form == "array").option("columnNameOfCorruptRecord", "_corrupt").schema("_none string, _corrupt string").json(path)
    # Spark reads the corrupt column only together with another one.
    return rows.where("_none IS NULL").select(F.col("_metadata.file_path").alias("file"), F.lit("no JSON").alias("reason"), F.col("_corrupt").alias("record")) \
        .where("record IS NOT NULL")


# ------------------------------------------------------------------ HTML

def _escape(c: Column) -> Column:
    for a, b in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")]:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def html_pages(df: DataFrame, chunk: str, columns: Sequence[str], row_header: str | None = None) -> DataFrame:
    """One HTML page per chunk holding a <table> of the chunk's rows (the
    chunk column bounds rows per page). With ``row_header`` each row begins
    with that column as a header cell, below an empty one, as a data frame's
    own export does."""
    cells = [F.concat(F.lit("<td>"), _escape(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>")) for c in columns]
    head = "".join(f"<th>{c}</th>" for c in columns)
    if row_header:
        cells.insert(0, F.concat(F.lit("<th>"), _escape(F.col(row_header).cast("string")), F.lit("</th>")))
        head = "<th></th>" + head
    row = F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))
    body = F.array_join(F.collect_list(row), "")
    page = F.concat(F.lit(f"<html><body><table border=\"1\" class=\"dataframe\"><thead><tr>{head}</tr></thead><tbody>"),
                    body, F.lit("</tbody></table></body></html>"))
    return df.groupBy(chunk).agg(page.alias("value")).select("value")


class TableParser(HTMLParser):
    """The first table of a page as rows of cells. A cell's text is all text
    inside it, tags left out and white space collapsed; a table inside a cell
    is part of that cell. Header rows are those of ``<thead>``, else the first
    rows that hold header cells only; a header cell elsewhere is a value. A cell
    that spans columns or rows stands in each of them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.done, self.found = 0, False, False
        self.in_head, self.rows, self.row, self.cell = False, [], None, None
        self.skipped = 0  # open script and style elements

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skipped += 1
        if self.done:
            return
        if tag == "table":
            self.depth += 1
            self.found = True
        elif self.depth == 1:
            if tag in ("thead", "tbody", "tfoot"):
                self._end_row()
                self.in_head = tag == "thead"
            elif tag == "tr":
                self._end_row()
                self.row = []
            elif tag in ("td", "th"):
                self._end_cell()
                if self.row is None:
                    self.row = []
                spans = {k: v for k, v in attrs if k in ("colspan", "rowspan")}
                self.cell = [tag == "th", [], *(self._span(spans.get(k)) for k in ("colspan", "rowspan"))]
            elif tag == "br":
                self.handle_data(" ")
        elif self.depth > 1 and tag in ("td", "th", "tr", "br"):
            self.handle_data(" ")

    @staticmethod
    def _span(value: str | None) -> int:
        return max(1, min(int(value), 1000)) if value and value.strip().isdigit() else 1

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skipped = max(0, self.skipped - 1)
        if self.done or not self.depth:
            return
        if tag == "table":
            if self.depth == 1:
                self._end_row()
                self.done = True
            self.depth -= 1
        elif self.depth == 1:
            if tag in ("td", "th"):
                self._end_cell()
            elif tag in ("tr", "thead", "tbody", "tfoot"):
                self._end_row()
                self.in_head = self.in_head and tag == "tr"

    def handle_data(self, data):
        if self.cell is not None and not self.skipped:
            self.cell[1].append(data)

    def _end_cell(self):
        if self.cell is not None:
            header, text, wide, high = self.cell
            self.row.append((header, " ".join("".join(text).split()) or None, wide, high))
            self.cell = None

    def _end_row(self):
        self._end_cell()
        if self.row:
            self.rows.append((self.in_head, self.row))
        self.row = None

    def table(self) -> tuple[list[str | None], list[list[str | None]]]:
        """Names and rows. Several header rows give one name of their parts."""
        self._end_row()
        grid, open_cells = [], {}  # column -> (header, text, rows left)
        for in_head, row in self.rows:
            line, cells, at = [], iter(row), 0
            while True:
                if at in open_cells:
                    header, text, left = open_cells.pop(at)
                    line.append((header, text))
                    if left > 1:
                        open_cells[at] = header, text, left - 1
                    at += 1
                    continue
                cell = next(cells, None)
                if cell is None:
                    if not any(c > at for c in open_cells):
                        break
                    line.append((False, None))
                    at += 1
                    continue
                header, text, wide, high = cell
                for _ in range(wide):
                    line.append((header, text))
                    if high > 1:
                        open_cells[at] = header, text, high - 1
                    at += 1
            grid.append((in_head, line))
        n = 0
        if any(in_head for in_head, _ in grid):
            heads, body = [r for h, r in grid if h], [r for h, r in grid if not h]
        else:
            while n < len(grid) and all(header for header, _ in grid[n][1]):
                n += 1
            heads, body = [r for _, r in grid[:n]], [r for _, r in grid[n:]]
        width = max((len(r) for r in heads), default=0)
        names = []
        for i in range(width):
            parts = dict.fromkeys(r[i][1] for r in heads if i < len(r) and r[i][1])
            names.append("_".join(parts) or None)
        return names, [[text for _, text in r] for r in body]


class _Pages:
    """(kind, text) of a split's pages and of the fragments at its ends, from
    pieces that end before a '>'."""

    def __init__(self, file: str, block: int):
        self.file, self.block, self.buffer, self.crossing = file, block, [], block > 0

    def piece(self, value: str) -> Iterator[tuple]:
        self.buffer.append(value)
        if value[-16:].rstrip().lower().endswith("</html"):
            yield self.file, self.block, HEAD if self.crossing else WHOLE, ">".join(self.buffer)
            self.buffer, self.crossing = [], False

    def end(self) -> Iterator[tuple]:
        if self.buffer:
            yield self.file, self.block, MIDDLE if self.crossing else TAIL, ">".join(self.buffer)


def _html_rows(spark: SparkSession, path: str) -> DataFrame:
    """(file, reason, record, head, cells); a page's first row has its header
    and no cells."""
    parts = map_splits(pieces(spark, path, ">"), _Pages, "file string, block long, kind string, text string")
    pages = parts.where(F.col("kind") == WHOLE).select("file", "text").unionByName(
        joined_fragments(parts.where(F.col("kind") != WHOLE), ">").select("file", "text"))

    class Parse:
        def __init__(self, file: str, block: int):
            self.file = file

        def piece(self, value: str) -> Iterator[tuple]:
            if not value.strip():
                return
            parser = TableParser()
            parser.feed(value + ">")
            names, rows = parser.table()
            if not parser.found:
                yield self.file, "no table", value[:1000], None, None
                return
            width = max([len(names), *map(len, rows)])
            seen: Counter = Counter()
            head = []
            for i in range(width):
                name = (names[i] if i < len(names) else None) or f"Unnamed: {i}"
                head.append(f"{name}.{seen[name]}" if seen[name] else name)
                seen[name] += 1
            yield self.file, None, None, head, None
            for row in rows:
                yield self.file, None, None, head, row

        def end(self) -> Iterator[tuple]:
            return iter(())

    found = pages.select("file", F.lit(0).cast("long").alias("block"), F.col("text").alias("value"))
    return map_splits(found, Parse, BAD + ", head array<string>, cells array<string>")


def read_html_tables(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of the first <table> of every page; each page's header cells name
    its columns (a nameless one is ``Unnamed: <place>``), a column that a page
    lacks and an empty cell are NULL."""
    rows = _html_rows(spark, path).where("reason IS NULL")
    if columns is None:
        names = (rows.where("cells IS NULL").select(F.posexplode("head").alias("at", "name"))
                 .groupBy("name").agg(F.min("at").alias("at")).collect())
        columns = [r["name"] for r in sorted(names, key=lambda r: (r["at"], r["name"]))]
    place = [F.array_position("head", c) for c in columns]
    return rows.where("cells IS NOT NULL").select(
        *[F.when(at > 0, F.get("cells", (at - 1).cast("int"))).alias(c) for c, at in zip(columns, place)])


def bad_html(spark: SparkSession, path: str) -> DataFrame:
    """Pages without a table."""
    return _html_rows(spark, path).where("reason IS NOT NULL").select("file", "reason", "record")
