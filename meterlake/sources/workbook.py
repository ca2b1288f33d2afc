"""Workbook files -> ``cells`` rows, as a Spark job.

``spark.read.format("binaryFile")`` lists the ``.xlsx`` files (suffix matched
in any letter case) and carries each file's bytes in one row; a
``mapInPandas`` task opens each workbook with the standard library (an
``.xlsx`` file is a zip of XML parts) and emits one row per non-empty cell
(schema ``CELLS``). Cell values are the stored (computed) values, never
formulas. Files are not splittable, so the parallelism is the number of
files; the scan packs files into tasks by size
(``spark.sql.files.maxPartitionBytes``).

Kinds: ``s`` text, ``n`` number (rendered as Python renders an int or
float), ``d`` a number in a date/time format (rendered
``yyyy-MM-dd HH:mm:ss``), ``b`` boolean (``TRUE``/``FALSE``), ``e`` error
text (``#N/A``).
"""

from __future__ import annotations

import datetime as _dt
import io
import posixpath
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_name
from ..schema import CELLS

# XML namespaces of the workbook format, the built-in number
# format ids that are dates or times, and the day zero of both date systems.
NS_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
NS_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
NS_PKG_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
BUILTIN_DATE_FORMATS = set(range(14, 23)) | set(range(45, 48))
EPOCH_1900 = _dt.datetime(1899, 12, 30)
EPOCH_1904 = _dt.datetime(1904, 1, 1)

XLSX_GLOB = "*.[xX][lL][sS][xX]"

_M = "{%s}" % NS_MAIN
_DATE_TOKENS = re.compile(r"[dmyhs]", re.I)
_QUOTED = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')


def _col_index(ref: str) -> int:
    n = 0
    for ch in ref:
        if "A" <= ch <= "Z":
            n = n * 26 + (ord(ch) - 64)
        elif "a" <= ch <= "z":
            n = n * 26 + (ord(ch) - 96)
        else:
            break
    return n - 1


def _number_text(v: str) -> str:
    try:
        f = float(v)
    except ValueError:
        return v
    if f.is_integer() and abs(f) < 1e16:
        return str(int(f))
    return repr(f)


def _text_of(el) -> str:
    """Text of a shared/inline string: its ``<t>``, or the ``<t>`` of each
    rich-text run ``<r>``; phonetic runs (``<rPh>``) are not cell text."""
    out = []
    for child in el:
        if child.tag == _M + "t":
            out.append(child.text or "")
        elif child.tag == _M + "r":
            t = child.find(_M + "t")
            if t is not None:
                out.append(t.text or "")
    return "".join(out)


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Indexes into ``cellXfs`` whose number format is a date or time."""
    try:
        root = ET.fromstring(z.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {}
    fmts = root.find(_M + "numFmts")
    if fmts is not None:
        for f in fmts.findall(_M + "numFmt"):
            code = _QUOTED.sub("", f.get("formatCode", ""))
            custom[int(f.get("numFmtId"))] = bool(_DATE_TOKENS.search(code))
    out = set()
    xfs = root.find(_M + "cellXfs")
    if xfs is not None:
        for i, xf in enumerate(xfs.findall(_M + "xf")):
            fid = int(xf.get("numFmtId", "0"))
            if fid in BUILTIN_DATE_FORMATS or custom.get(fid, False):
                out.add(i)
    return out


def _serial_text(serial: float, epoch: _dt.datetime) -> str | None:
    try:
        t = epoch + _dt.timedelta(days=serial)
    except (OverflowError, ValueError):
        return None
    # a serial is exact to about a millisecond
    t = t.replace(microsecond=0) + _dt.timedelta(milliseconds=round(t.microsecond / 1e3))
    return t.isoformat(" ", "milliseconds" if t.microsecond else "seconds")


def _sheets(z: zipfile.ZipFile) -> tuple[list[tuple[str, str]], bool]:
    """(sheet name, part path) in workbook order, and the 1904 flag."""
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    pr = wb.find(_M + "workbookPr")
    date1904 = pr is not None and pr.get("date1904") in ("1", "true")
    rels = {}
    try:
        rr = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        for r in rr.findall("{%s}Relationship" % NS_PKG_REL):
            target = r.get("Target", "")
            path = target.lstrip("/") if target.startswith("/") else posixpath.normpath(
                posixpath.join("xl", target))
            rels[r.get("Id")] = path
    except KeyError:
        pass
    out = []
    sheets = wb.find(_M + "sheets")
    for i, s in enumerate([] if sheets is None else sheets.findall(_M + "sheet")):
        rid = s.get("{%s}id" % NS_REL)
        out.append((s.get("name", f"Sheet{i + 1}"), rels.get(rid, f"xl/worksheets/sheet{i + 1}.xml")))
    return out, date1904


def workbook_cells(name: str, content: bytes) -> Iterator[tuple]:
    """Yield ``CELLS`` tuples for one workbook."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        try:
            sst_root = ET.fromstring(z.read("xl/sharedStrings.xml"))
            shared = [_text_of(si) for si in sst_root.findall(_M + "si")]
        except KeyError:
            shared = []
        dates = _date_styles(z)
        sheets, date1904 = _sheets(z)
        epoch = EPOCH_1904 if date1904 else EPOCH_1900
        for idx, (sheet_name, part) in enumerate(sheets):
            data = z.open(part)
            row_no, parent = 0, None
            # rows are dropped from their parent once read; the shared strings stay
            for ev, el in ET.iterparse(data, events=("start", "end")):
                if ev == "start":
                    parent = el if el.tag == _M + "sheetData" else parent
                    continue
                if el.tag != _M + "row":
                    continue
                r = el.get("r")
                row_no = int(r) if r else row_no + 1
                col = -1
                for c in el.findall(_M + "c"):
                    ref = c.get("r")
                    col = _col_index(ref) if ref else col + 1
                    t = c.get("t", "n")
                    v = c.find(_M + "v")
                    vt = v.text if v is not None else None
                    if t == "inlineStr":
                        is_ = c.find(_M + "is")
                        value, kind = (_text_of(is_) if is_ is not None else None), "s"
                    elif t == "s":
                        value = shared[int(vt)] if vt is not None and int(vt) < len(shared) else None
                        kind = "s"
                    elif t == "str":
                        value, kind = vt, "s"
                    elif t == "b":
                        value, kind = (None if vt is None else ("TRUE" if vt == "1" else "FALSE")), "b"
                    elif t == "e":
                        value, kind = vt, "e"
                    elif t == "d":
                        value, kind = (None if vt is None else vt.replace("T", " ")), "d"
                    else:
                        if vt is None:
                            continue
                        if int(c.get("s", "0")) in dates:
                            try:
                                value, kind = _serial_text(float(vt), epoch), "d"
                            except ValueError:
                                value, kind = vt, "s"
                        else:
                            value, kind = _number_text(vt), "n"
                    if value is None or value == "":
                        continue
                    yield (name, idx, sheet_name, row_no, col, value, kind)
                if parent is not None:
                    parent.clear()


# Cells that a task holds at most before it hands them on.
CELLS_PER_BATCH = 200_000


def _decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cols = [f.name for f in CELLS.fields]
    for pdf in batches:
        rows = []
        for name, content in zip(pdf["src_file"], pdf["content"]):
            cells = workbook_cells(name, bytes(content))
            while True:
                try:
                    rows.extend(islice(cells, CELLS_PER_BATCH - len(rows)))
                except (zipfile.BadZipFile, ET.ParseError, KeyError) as e:
                    # never publish a workbook that was read in part
                    raise ValueError(f"unreadable workbook {name}: {type(e).__name__}: {e}") from e
                if len(rows) < CELLS_PER_BATCH:
                    break
                yield pd.DataFrame(rows, columns=cols)
                rows = []
        if rows:
            yield pd.DataFrame(rows, columns=cols)


def check_names(spark: SparkSession, path: str) -> None:
    """Fail where ``path`` holds workbooks that Spark's listing leaves out
    (names that start with ``_`` or ``.``): they would be lost unseen."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/[_.]" + XLSX_GLOB)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    names = [f.getPath().getName() for f in found if f.isFile()]
    # the listing's own exceptions from its rule
    lost = sorted(n for n in names if n[0] == "." or not ("=" in n or n.startswith("_metadata") or n.startswith("_common_metadata")))
    if lost:
        raise ValueError(f"workbooks in {path} that Spark does not list (rename them): {', '.join(lost)}")


def list_workbooks(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """``binaryFile`` listing of the workbooks in ``path`` (one folder, where
    names are unique): path, modificationTime, length, content. Fails on names
    in it that Spark would leave out."""
    check_names(spark, path)
    return (spark.read.format("binaryFile").option("pathGlobFilter", XLSX_GLOB)
            .option("recursiveFileLookup", str(recursive).lower()).load(path))


def cells_of(files: DataFrame) -> DataFrame:
    """``binaryFile`` rows -> cells. Each task decodes the files it was
    given; run it under ``few_files_per_batch`` so an Arrow batch holds a
    few workbooks, not thousands."""
    src = files.select(file_name(F.col("path")).alias("src_file"), "content")
    return src.mapInPandas(_decode, CELLS)


class few_files_per_batch:
    """Context manager: Arrow batches of ``n`` rows while decoding files
    (the setting is read when the job runs, so wrap the action)."""

    KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def __init__(self, spark: SparkSession, n: int = 8):
        self.spark, self.n, self.old = spark, n, None

    def __enter__(self):
        self.old = self.spark.conf.get(self.KEY, None)
        self.spark.conf.set(self.KEY, str(self.n))
        return self

    def __exit__(self, *exc):
        if self.old is None:
            self.spark.conf.unset(self.KEY)
        else:
            self.spark.conf.set(self.KEY, self.old)
        return False


# Partition values are read as text: a hall called 007 stays one.
ARCHIVE = ("src_file string, modificationTime timestamp, length long, sha256 string, content binary, "
           "hall_id string, file string")


def archive(files: DataFrame, root: str) -> dict:
    """Keep each original workbook under ``files/hall_id=<h>/file=<name>/`` with
    its time, length and SHA-256 digest. A later file of the same hall and name
    replaces it; all others stay. Returns the number of files and bytes."""
    return archive_named(files, root)[0]


def archive_named(files: DataFrame, root: str) -> tuple[dict, list[tuple[str, str]]]:
    """``archive`` in one pass over the files, with the (hall, file) names
    written: for a bounded number of files, as in a micro-batch."""
    from ..functions.text import hall_id_of
    from .lake import layer_path, write_table
    df = files.select(
        hall_id_of(F.col("path")).alias("hall_id"),
        file_name(F.col("path")).alias("src_file"),
        "modificationTime", "length",
        F.sha2(F.col("content"), 256).alias("sha256"),
        "content").withColumn("file", F.col("src_file"))
    m = write_table(df, layer_path(root, "files"), ["hall_id", "file"], "files", rebalance=False,
                    extra={"bytes": F.sum("length"), "names": F.collect_set(F.struct("hall_id", "file"))})
    names = sorted((r["hall_id"], r["file"]) for r in m.pop("files_names", []))
    return m, names


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """Every archived workbook, as last written. Columns of ``ARCHIVE``."""
    from .lake import layer_path
    return spark.read.schema(ARCHIVE).parquet(layer_path(root, "files"))


def archived(spark: SparkSession, root: str, names: list[tuple[str, str]]) -> DataFrame:
    """The archived workbooks of the given (hall, file) names: only their
    folders are listed and read. Columns of ``ARCHIVE`` and ``path``."""
    from .lake import layer_path
    from .versions import partition_folder
    base = layer_path(root, "files")
    paths = [f"{base}/{partition_folder('hall_id', h)}/{partition_folder('file', f)}" for h, f in names]
    return spark.read.schema(ARCHIVE).option("basePath", base).parquet(*paths).withColumn("path", F.col("src_file"))
