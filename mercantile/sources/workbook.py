"""Workbook (.xlsx) ingest and export as Spark jobs.

No workbook library is installed here, so a small stdlib codec (zip + XML)
reads and writes the one-sheet SpreadsheetML subset the jobs need:

* ingest: ``binaryFile`` lists and loads the files, ``mapInArrow`` streams
  one file at a time on the executors into text columns named by the header
  row, and Spark casts them to the target schema; a task holds the files'
  compressed bytes and one batch of rows, never a whole sheet;
* export: a Python data source writer; every task streams its partition into
  its own workbook, rolling to a new file at the sheet row limit, through
  Arrow's file systems; files appear in the target folder at the commit.
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

# SpreadsheetML namespaces, content types and the sheet limit.
MAIN_NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PKG_REL_NS = "http://schemas.openxmlformats.org/package/2006/relationships"
SHEET_ROW_LIMIT = 1_048_576
EXCEL_EPOCH = dt.date(1899, 12, 30)

CONTENT_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '</Types>')
ROOT_RELS = (
    f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="{PKG_REL_NS}">'
    f'<Relationship Id="rId1" Type="{REL_NS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
WORKBOOK_RELS = (
    f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><Relationships xmlns="{PKG_REL_NS}">'
    f'<Relationship Id="rId1" Type="{REL_NS}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')


def column_letters(index: int) -> str:
    """0 -> A, 25 -> Z, 26 -> AA."""
    out = ""
    index += 1
    while index:
        index, rem = divmod(index - 1, 26)
        out = chr(65 + rem) + out
    return out


def column_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if not ch.isalpha():
            break
        n = n * 26 + (ord(ch.upper()) - 64)
    return n - 1


class Number(str):
    """Text of a numeric cell."""


_ESCAPED = re.compile("_x([0-9A-Fa-f]{4})_")
_ILLEGAL = re.compile("[\x00-\x08\x0b\x0c\x0d\x0e-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")


def encode_text(text: str) -> str:
    """Characters that XML cannot hold, as the format's ``_xHHHH_``."""
    return _ILLEGAL.sub(lambda m: f"_x{ord(m[0]):04X}_", text)


def decode_text(text: str) -> str:
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), text)


def _cell(ref: str, value) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)) or type(value).__name__ == "Decimal":
        return f'<c r="{ref}"><v>{value}</v></c>'
    if isinstance(value, (dt.date, dt.datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value.isoformat()
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(encode_text(str(value)))}</t></is></c>'


def write_workbook(fileobj, sheet: str, header: list[str], rows: Iterable[tuple]) -> int:
    """Stream one workbook; returns the number of data rows written."""
    n = 0
    with zipfile.ZipFile(fileobj, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", CONTENT_TYPES)
        z.writestr("_rels/.rels", ROOT_RELS)
        z.writestr("xl/_rels/workbook.xml.rels", WORKBOOK_RELS)
        z.writestr("xl/workbook.xml",
                   f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                   f'<workbook xmlns="{MAIN_NS}" xmlns:r="{REL_NS}"><sheets>'
                   f'<sheet name="{escape(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        with z.open("xl/worksheets/sheet1.xml", "w") as out:
            out.write(f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
                      f'<worksheet xmlns="{MAIN_NS}"><sheetData>'.encode())
            cells = "".join(_cell(f"{column_letters(i)}1", h) for i, h in enumerate(header))
            out.write(f'<row r="1">{cells}</row>'.encode())
            for n, row in enumerate(rows, start=1):
                r = n + 1
                cells = "".join(_cell(f"{column_letters(i)}{r}", v) for i, v in enumerate(row))
                out.write(f'<row r="{r}">{cells}</row>'.encode())
            out.write(b"</sheetData></worksheet>")
    return n


class SharedStrings:
    """A workbook's string table as Arrow arrays: its text and little more."""

    CHUNK = 8192

    def __init__(self, texts: Iterable[str]):
        import pyarrow as pa
        self.chunks = [pa.array(some, pa.string()) for some in iter(lambda: list(itertools.islice(texts, self.CHUNK)), [])]
        self.size = sum(map(len, self.chunks))

    def __getitem__(self, i: int) -> str:
        i = i + self.size if i < 0 else i
        if not 0 <= i < self.size:
            raise IndexError(i)
        return self.chunks[i // self.CHUNK][i % self.CHUNK].as_py()


def _elements(file, tag: str) -> Iterator[ET.Element]:
    """Each element ``tag`` of an XML file as it ends.  It leaves the tree then:
    an emptied element that stayed would cost memory for every row."""
    path = []
    for event, el in ET.iterparse(file, events=("start", "end")):
        if event == "start":
            path.append(el)
            continue
        path.pop()
        if el.tag == tag:
            yield el
            el.clear()
            if path:
                path[-1].remove(el)


def _shared_strings(z: zipfile.ZipFile) -> Iterator[str]:
    if "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as f:
            for si in _elements(f, f"{{{MAIN_NS}}}si"):
                yield decode_text("".join(t.text or "" for t in si.iter(f"{{{MAIN_NS}}}t")))


def sheet_rows(file) -> Iterator[list[str | None]]:
    """First sheet of a workbook (a seekable file), row by row as text cells."""
    z = zipfile.ZipFile(file)
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    first = wb.find(f"{{{MAIN_NS}}}sheets/{{{MAIN_NS}}}sheet")
    rid = first.get(f"{{{REL_NS}}}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in rels if r.get("Id") == rid)
    path = target.lstrip("/") if target.startswith("/") else "xl/" + target
    shared = SharedStrings(_shared_strings(z))
    with z.open(path) as f:
        for el in _elements(f, f"{{{MAIN_NS}}}row"):
            row: dict[int, str | None] = {}
            for i, c in enumerate(el.iter(f"{{{MAIN_NS}}}c")):
                col = column_index(c.get("r")) if c.get("r") else i
                kind = c.get("t")
                if kind == "inlineStr":
                    val = decode_text("".join(t.text or "" for t in c.iter(f"{{{MAIN_NS}}}t")))
                else:
                    v = c.find(f"{{{MAIN_NS}}}v")
                    val = None if v is None else v.text
                    if kind == "s" and val is not None:
                        val = shared[int(val)]
                    elif kind in (None, "n") and val is not None:
                        val = Number(val)
                    elif kind == "b" and val is not None:
                        val = "true" if val == "1" else "false"
                row[col] = val
            width = max(row) + 1 if row else 0
            yield [row.get(i) for i in range(width)]


def read_workbook(data: bytes) -> tuple[list[str], list[list[str | None]]]:
    """First sheet of a small workbook as (header, rows of text cells)."""
    rows = list(sheet_rows(io.BytesIO(data)))
    if not rows:
        return [], []
    header = [h or "" for h in rows[0]]
    return header, rows[1:]


def serial_date(text: str) -> str:
    """A numeric cell of a date column as ISO date; out of range it stays as it
    is and fails to parse later."""
    days = float(text)
    return (EXCEL_EPOCH + dt.timedelta(days=int(days))).isoformat() if 1 <= days < 2_958_466 else str(text)


#: Rows, and characters, of a batch that leaves the parser.
BATCH_ROWS = 10_000
BATCH_CHARS = 4 << 20
#: Parsed rows of a file wait in memory up to here, beyond it in the task's temp folder.
HELD_BYTES = 16 << 20


def _parse_files(target: T.StructType):
    """Every workbook of the batches as rows of text.  A file's rows are given
    out when it has been read to its end, as a file that breaks off gives one
    problem row and nothing else."""
    names = target.fieldNames()
    dates = {f.name for f in target if isinstance(f.dataType, T.DateType)}

    def run(batches):
        import pyarrow as pa
        schema = pa.schema([*[(n, pa.string()) for n in names], ("_file", pa.string()), ("_row", pa.int64()),
                            ("_problem", pa.string()), ("_absent", pa.string())])
        text = pa.schema([*[(n, pa.string()) for n in names], ("_row", pa.int64())])

        def whole(columns, path, problem, absent):
            n = len(columns[-1])
            same = [pa.array([v] * n, pa.string()) for v in (path, problem, ",".join(absent))]
            return pa.RecordBatch.from_arrays([*columns[:-1], same[0], columns[-1], *same[1:]], schema=schema)

        def parse(content, held):
            """Writes the file's rows to ``held``; its unknown and absent columns
            and what was wrong with a value."""
            found = sheet_rows(content)
            header = [h or "" for h in next(found, [])]
            unknown = [h for h in header if h and h not in names]
            pos = {h: i for i, h in enumerate(header)}
            absent = [n for n in names if n not in pos]
            out, size, wrong = [[] for _ in text], 0, None
            with pa.ipc.new_stream(held, text) as to:
                def flush():
                    to.write_batch(pa.RecordBatch.from_arrays(
                        [pa.array(v, f.type) for v, f in zip(out, text, strict=True)], schema=text))

                for k, row in enumerate(found, start=2):
                    if wrong is not None or not any(v not in (None, "") for v in row):
                        continue
                    for n, values in zip(names, out):
                        i = pos.get(n)
                        v = row[i] if i is not None and i < len(row) else None
                        if n in dates and isinstance(v, Number):
                            try:
                                v = serial_date(v)
                            except Exception as e:  # noqa: BLE001  (the rest is still read: it may not be XML)
                                wrong = e
                        values.append(None if v is None or v == "" else str(v))
                        size += len(v or "")
                    out[-1].append(k)
                    if len(out[-1]) >= BATCH_ROWS or size >= BATCH_CHARS:
                        flush()
                        out, size = [[] for _ in text], 0
                if out[-1]:
                    flush()
            return unknown, absent, wrong

        for batch in batches:
            paths, contents = batch.column("path"), batch.column("content")
            for i in range(batch.num_rows):
                path = paths[i].as_py()
                with tempfile.SpooledTemporaryFile(max_size=HELD_BYTES) as held:
                    absent = []
                    try:
                        unknown, absent, wrong = parse(pa.BufferReader(contents[i].as_buffer()), held)
                        if wrong is not None:
                            raise wrong
                    except Exception as e:  # noqa: BLE001  (a broken file is quarantined)
                        none = [pa.nulls(1, f.type) for f in text]
                        yield whole(none, path, f"unreadable workbook: {type(e).__name__}", absent)
                        continue
                    held.seek(0)
                    for part in pa.ipc.open_stream(held):
                        yield whole(part.columns, path, f"unknown columns {unknown}" if unknown else None, absent)
    return run


def cast_text(c: str, dtype: T.DataType):
    """Text -> typed value, NULL when it does not parse.  Dates are ISO."""
    if isinstance(dtype, T.DateType):
        return F.when(F.col(c).rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), F.expr(f"try_cast({c} AS date)"))
    return F.expr(f"try_cast({c} AS {dtype.simpleString()})")


def typed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to ``schema``; a value that does not parse is named
    in ``_problem``.  Keeps ``_file``, ``_row``, ``_absent``."""
    casts = {f.name: cast_text(f.name, f.dataType) for f in schema}
    failed = [F.when(F.col(f.name).isNotNull() & casts[f.name].isNull(), F.lit(f"bad value in {f.name}"))
              for f in schema]
    return raw.select(*[casts[f.name].alias(f.name) for f in schema], "_file", "_row", "_absent",
                      F.coalesce(F.col("_problem"), *failed).alias("_problem"))


def read_workbooks(spark: SparkSession, path: str, schema: T.StructType,
                   glob: str = "*.xlsx") -> DataFrame:
    """Every workbook under ``path`` as rows of ``schema`` plus
    ``_file``, ``_row``, ``_absent`` (columns the file does not have) and
    ``_problem`` (cast failures and unreadable files are named there; see
    :func:`mercantile.sources.ingest.ingest` for the all-or-nothing rule per
    file)."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema]
                        + [T.StructField("_file", T.StringType()), T.StructField("_row", T.LongType()),
                           T.StructField("_problem", T.StringType()), T.StructField("_absent", T.StringType())])
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path).select("path", "content"))
    return typed(files.mapInArrow(_parse_files(schema), text), schema)


class WorkbookSource(DataSource):
    """``df.write.format("workbook").option("sheet", ...).save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return WorkbookWriter(self.options, schema, overwrite)


def file_system(folder: str):
    """(file system, path) of a folder; any scheme that Arrow's file systems
    reach from the workers, plain paths are local or mounted ones."""
    from pyarrow import fs
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(folder)
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), local_path(folder)
    return fs.FileSystem.from_uri(folder)


def local_path(folder: str) -> str:
    """Path of a ``file:`` URI."""
    if folder.startswith("file:"):
        folder = folder[5:]
        while folder.startswith("//"):
            folder = folder[1:]
    return folder


class WorkbookWriter(DataSourceWriter):
    """Tasks write into a staging folder of their write; the commit moves the
    files in (overwriting: after the workbooks that were there are gone), an
    abort drops the staging folder.  With ``per_key`` columns a workbook holds
    one key only; rows come sorted by key."""

    def __init__(self, options, schema: T.StructType, overwrite: bool):
        self.folder = options.get("path")
        self.overwrite = overwrite
        self.sheet = options.get("sheet", "Sheet1")
        self.header = schema.fieldNames()
        self.limit = int(options.get("max_rows", SHEET_ROW_LIMIT - 1))
        self.write_id = options.get("write_id") or uuid.uuid4().hex[:12]
        self.keys = [self.header.index(k) for k in options.get("per_key", "").split(",") if k]

    def _staging(self, path: str) -> str:
        return f"{path}/_staging-{self.write_id}"

    def write(self, iterator) -> WriterCommitMessage:
        """Rows stream from the task's iterator into the open sheet; after
        ``max_rows`` rows, or with a new key, a new workbook starts.  Nothing
        is buffered."""
        from pyspark import TaskContext
        fs, path = file_system(self.folder)
        staging = self._staging(path)
        fs.create_dir(staging, recursive=True)
        ctx = TaskContext.get()
        # Deterministic per write call and partition: a retried or
        # speculative attempt replaces the same files instead of adding more.
        tag = f"{self.write_id}-{ctx.partitionId() if ctx else 0:05d}"
        files = []
        for _, rows in itertools.groupby(iterator, lambda r: tuple(r[k] for k in self.keys)):
            while (first := next(rows, None)) is not None:
                chunk = itertools.chain([tuple(first)],
                                        (tuple(r) for r in itertools.islice(rows, self.limit - 1)))
                name = f"part-{tag}-{len(files):04d}.xlsx"
                attempt = f"{staging}/.{name}-{ctx.attemptNumber() if ctx else 0}"
                with fs.open_output_stream(attempt) as f:
                    write_workbook(_Forward(f), self.sheet, self.header, chunk)
                fs.move(attempt, f"{staging}/{name}")
                files.append(name)
        return WorkbookCommit(files)

    def commit(self, messages) -> None:
        from pyarrow.fs import FileSelector
        fs, path = file_system(self.folder)
        if self.overwrite:
            for old in fs.get_file_info(FileSelector(path, allow_not_found=True)):
                if old.base_name.endswith(".xlsx"):
                    fs.delete_file(old.path)
        for m in messages:
            for name in getattr(m, "files", []):
                fs.move(f"{self._staging(path)}/{name}", f"{path}/{name}")
        self._drop(fs, path)

    def abort(self, messages) -> None:
        self._drop(*file_system(self.folder))

    def _drop(self, fs, path: str) -> None:
        from pyarrow.fs import FileType
        if fs.get_file_info(self._staging(path)).type == FileType.Directory:
            fs.delete_dir(self._staging(path))


class _Forward(io.RawIOBase):
    """An output stream that zip can write to without seeking."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)


class WorkbookCommit(WriterCommitMessage):
    def __init__(self, files):
        self.files = files


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WorkbookSource)


def write_workbooks(df: DataFrame, folder: str, sheet: str, max_rows: int | None = None,
                    mode: str = "overwrite", per_key: Sequence[str] = ()) -> str:
    """One workbook per task (``df`` partitioning decides the files), or
    with ``per_key`` at least one per key, each of one key only."""
    register(df.sparkSession)
    w = (df.write.format("workbook").mode(mode).option("sheet", sheet)
         .option("write_id", uuid.uuid4().hex[:12]).option("per_key", ",".join(per_key)))
    if max_rows:
        w = w.option("max_rows", str(max_rows))
    w.save(folder)
    return folder
