"""Tables out: partitioned Parquet, delimited text, feature XML, and the grouped XLSX report."""

from __future__ import annotations

import os
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from itertools import chain, islice
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakloom.functions.expr import SEPARATOR

CELL_CHARS = 32_767
SHEET_ROWS = 1_048_576


def parquet(df: DataFrame, path: str, by: tuple[str, ...] = ("fdr",)) -> None:
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def delimited(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Text files with a header; nested columns as JSON, rows' places in their files left out."""
    df = df.drop("ordinal")
    flat = [F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f"`{f.name}`") for f in df.schema.fields]
    df.select(*flat).write.mode("overwrite").csv(path, sep=sep, header=True, quote='"', escape='"')


def feature_xml(df: DataFrame, path: str, unassigned: DataFrame | None = None) -> None:
    """Features (feature_id, rt, mz, intensity, charge) as XML rows, with what else there is of: hulls (boxes of rt and m/z), idents (rt, mz, score_type, proteins and hits
    of score, sequence, charge, raw_peptide).  unassigned: identifications of no feature, in the same form, into ``path-unassigned``."""
    dim = lambda d, c: F.struct(F.lit(d).alias("_dim"), F.col(c).alias("_VALUE"))
    columns = [F.col("feature_id").alias("_id"), F.array(dim("0", "rt"), dim("1", "mz")).alias("position"), F.col("intensity"), F.col("charge")]
    if "hulls" in df.columns:
        corner = lambda x, y: F.struct(x.alias("_x"), y.alias("_y"))
        corners = lambda h: F.array(corner(h.rt_start, h.mz_start), corner(h.rt_end, h.mz_start), corner(h.rt_end, h.mz_end), corner(h.rt_start, h.mz_end))
        columns.append(F.transform("hulls", lambda h, k: F.struct(k.alias("_nr"), corners(h).alias("pt"))).alias("convexhull"))
    if "idents" in df.columns:
        columns.append(F.transform("idents", _ident).alias("PeptideIdentification"))
    df.select(*columns).write.mode("overwrite").format("xml").option("rootTag", "featureList").option("rowTag", "feature").save(path)
    if unassigned is not None:
        rows = unassigned.select(_ident(F.struct("*")).alias("i")).select("i.*")
        rows.write.mode("overwrite").format("xml").option("rootTag", "featureMap").option("rowTag", "UnassignedPeptideIdentification").save(f"{path}-unassigned")


def _ident(i: Column) -> Column:
    user = lambda name, value: F.array(F.struct(F.lit("string").alias("_type"), F.lit(name).alias("_name"), value.alias("_value")))
    hit = lambda h: F.struct(h.score.alias("_score"), h.sequence.alias("_sequence"), h.charge.alias("_charge"), user("raw_peptide", h.raw_peptide).alias("UserParam"))
    hits = F.transform(i["hits"], hit)
    return F.struct(i["score_type"].alias("_score_type"), i["rt"].alias("_RT"), i["mz"].alias("_MZ"), hits.alias("PeptideHit"), user("proteins", i["proteins"]).alias("UserParam"))


# The groups of the report in order, each with its column (of every run, or the element's own), its label and its width in pixels.
REPORT = (
    ("openms_ceid", "Identifier", 128),
    ("intensity", "Intensities", 96),
    ("l_pep_ident", "Peptide identification", 96),
    ("l_raw_pep_ident", "Modified Peptide identification", 96),
    ("l_prot_ident", "Protein identification", 96),
    ("charge", "Charge", 96),
    ("l_ms2_scans", "MS2_Scans", 96),
    ("feature_global_min_mz", "Feature_Global_mz_start", None),
    ("feature_global_max_mz", "Feature_Global_mz_end", None),
    ("feature_global_min_rt", "Feature_Global_rt_start", None),
    ("feature_global_max_rt", "Feature_Global_rt_end", None),
    ("first_iso_global_min_mz", "Feature_First_Isotope_mz_start", None),
    ("first_iso_global_max_mz", "Feature_First_Isotope_mz_end", None),
    ("first_iso_global_min_rt", "Feature_First_Isotope_rt_start", None),
    ("first_iso_global_max_rt", "Feature_First_Isotope_rt_end", None),
    ("openms_fid", "Feauture_IDs", None),
    ("l_mz_start", "Single_Isotope_mz_start", None),
    ("l_mz_end", "Single_Isotope_mz_end", None),
    ("l_rt_start", "Single_Isotope_rt_start", None),
    ("l_rt_end", "Single_Isotope_rt_end", None),
    ("l_intensities", "XICs_intensities", None),
    ("l_retention_times", "XICs_retention_times", None),
    ("l_mass_to_charges", "XICs_mass_to_charges", None),
)


def layout(columns: list[str]) -> list[tuple[str, list[str], int | None]]:
    """Report groups that the table has columns of: label, columns, width; other columns are left out."""
    own = [(label, [c for c in columns if c == name or c.endswith(SEPARATOR + name)], width) for name, label, width in REPORT]
    return [g for g in own if g[1]]


def _letters(k: int) -> str:
    out = ""
    while k >= 0:
        out, k = chr(65 + k % 26) + out, k // 26 - 1
    return out


def _cell(row: int, col: int, value: object, style: int) -> str:
    at = f'r="{_letters(col)}{row}" s="{style}"'
    if value is None:
        return f"<c {at}/>"
    if isinstance(value, (int, float)) and not isinstance(value, bool) and value == value and abs(value) != float("inf"):
        return f"<c {at}><v>{value!r}</v></c>"
    if len(text := str(value)) > CELL_CHARS:
        raise ValueError(f"a sheet's cell holds {CELL_CHARS} characters, this one has {len(text)}; write the table as text instead")
    return f'<c {at} t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def _sheet(rows: Iterable, columns: list[str], groups: list[tuple[str, list[str], int | None]]) -> Iterable[str]:
    yield '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
    widths = [width for _, own, width in groups for _ in own]
    if any(widths):
        yield "<cols>" + "".join(f'<col min="{k}" max="{k}" width="{w / 7:.2f}" customWidth="1"/>' for k, w in enumerate(widths, 1) if w) + "</cols>"
    yield "<sheetData>"
    last = set()
    merges, at = [], 0
    heads = []
    for name, own, _ in groups:
        heads.append((at, name))
        if len(own) > 1:
            merges.append(f"{_letters(at)}1:{_letters(at + len(own) - 1)}1")
        at += len(own)
        last.add(at - 1)
    yield '<row r="1">' + "".join(_cell(1, c, name, 1) for c, name in heads) + "</row>"
    yield '<row r="2">' + "".join(_cell(2, c, name.split(SEPARATOR)[0], 1 + (c in last)) for c, name in enumerate(columns)) + "</row>"
    for r, row in enumerate(rows, 3):
        yield f'<row r="{r}">' + "".join(_cell(r, c, v, 3 * (c in last)) for c, v in enumerate(row)) + "</row>"
    yield "</sheetData>" + (f'<mergeCells count="{len(merges)}">' + "".join(f'<mergeCell ref="{m}"/>' for m in merges) + "</mergeCells>" if merges else "") + "</worksheet>"


_STYLES = """<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">
<fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills>
<borders count="2"><border/><border><left/><right style="thin"/><top/><bottom/><diagonal/></border></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>
<cellXfs count="4"><xf/><xf fontId="1" applyFont="1"/><xf fontId="1" borderId="1" applyFont="1" applyBorder="1"/><xf borderId="1" applyBorder="1"/></cellXfs></styleSheet>"""
_PARTS = {
    "[Content_Types].xml": """<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">
<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>
<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>
<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>
<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>""",
    "_rels/.rels": """<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">
<Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>""",
    "xl/workbook.xml": """<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"
xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="report" sheetId="1" r:id="r1"/></sheets></workbook>""",
    "xl/_rels/workbook.xml.rels": """<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">
<Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>
<Relationship Id="r2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/></Relationships>""",
    "xl/styles.xml": _STYLES,
}


def xlsx(df: DataFrame, folder: str, rows: int = SHEET_ROWS - 2) -> list[str]:
    """The wide table as workbooks of at most ``rows`` rows each, named in order; returns their names.

    A workbook has one sheet: a merged row of group names over the runs, a thin border after each group.
    Tasks write them, so nothing passes through the driver; ``folder`` must be one that all executors mount.
    A text longer than a cell may be raises.
    """
    groups = layout(df.columns)
    columns = [c for _, own, _ in groups for c in own]
    os.makedirs(folder, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        part = TaskContext.get().partitionId()
        names = []
        while (first := next(lines, None)) is not None:
            name = f"report-{part:05}-{len(names):03}.xlsx"
            own = f"{folder}/.{name}-{uuid.uuid4().hex}"  # a task that runs twice leaves one workbook
            with zipfile.ZipFile(own, "w", zipfile.ZIP_DEFLATED) as book:
                for path, text in _PARTS.items():
                    book.writestr(path, text)
                with book.open("xl/worksheets/sheet1.xml", "w") as sheet:
                    for text in _sheet(chain([first], islice(lines, rows - 1)), columns, groups):
                        sheet.write(text.encode())
            os.replace(own, f"{folder}/{name}")
            names.append(name)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())], ["name"])

    written = df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(write, "name string")
    return sorted(r[0] for r in written.collect())
