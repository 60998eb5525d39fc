"""Delimited files with fixed schemas: features, hills, identifications, queries, exported features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.functions.expr import fdr_key, run_key, strip_extension

# The columns of each kind of file.
FEATURES = "`charge` int, `intensitySum` double, `rtApex` double, `rtStart` double, `rtEnd` double, `mz` double, `monoisotope hill idx` bigint, `isotopes` string, `nIsotopes` int, `nScans` int, `isoerror` double, `isoerror2` double"
HILLS = "`hill_idx` bigint, `rtStart` double, `rtEnd` double, `mz` double, `hills_mz_array` string, `hills_scan_lists` string"
PSMS = "scan int, retention_time double, exp_mass_to_charge double, qvalue double, charge int, plain_peptide string, peptide_seq string, modified_peptide string, fasta_acc string, fasta_desc string"
QUERIES = "identifier string, mz_start double, mz_end double, rt_start double, rt_end double, mz double, ppm double, ms_level string, charge int, pep_idents string, raw_pep_idents string, prot_idents string, ms2_scans string"
EXPORTED = "openms_fid string, intensity double, charge int, l_pep_ident string, l_raw_pep_ident string, l_prot_ident string, l_mz_start string, l_mz_end string, l_rt_start string, l_rt_end string, l_retention_times string, l_mass_to_charges string, l_intensities string, l_ms2_scans string"


def _header(spark: SparkSession, path: str) -> str:
    """First line of a file, unpacked if its name says it is packed."""
    jvm, conf = spark.sparkContext._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(conf).open(at)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(at)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def delimited(spark: SparkSession, paths: str | list[str], schema: str, sep: str = "\t") -> DataFrame:
    """Columns of ``schema`` that a file's own header names, in any order; the others are null.  Files whose headers
    differ are read apart and put together by name.  Quotes are doubled inside quoted cells, and the run and FDR come
    from the file name.  ``ordinal`` orders rows as they stand in their file, also where a large file is read in pieces.

    The driver reads one line of each file, no more.
    """
    files = [r.path for r in spark.read.format("binaryFile").load(paths).select("path").collect()]
    kinds: dict[str, list[str]] = {}
    for f in sorted(files):
        kinds.setdefault(_header(spark, f), []).append(f)
    wanted = spark.createDataFrame([], schema).schema
    out = None
    for header, own in kinds.items():
        names = [h.strip('"') for h in header.lstrip("\ufeff").rstrip("\r").split(sep)]
        if header.strip():
            texts = ", ".join(f"`{n}` string" for n in names)
            df = spark.read.csv(own, schema=texts, header=True, sep=sep, quote='"', escape='"', maxCharsPerColumn=-1, enforceSchema=False)
            picked = [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted]
            base = strip_extension(F.col("_metadata.file_name"))
            # rows of one piece of a file are read in order by one task
            place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
            one = df.select(run_key(base).alias("run"), fdr_key(base).alias("fdr"), *picked, place.alias("ordinal"))
            out = one if out is None else out.unionByName(one)
    if out is None:
        return spark.createDataFrame([], f"run string, fdr string, {schema}, ordinal struct<file: string, start: bigint, row: bigint>")
    return out


def directories(spark: SparkSession, pattern: str) -> DataFrame:
    """(run, path, kind) of directories that match a glob, such as raw data that come as folders."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at) or []
    paths = spark.createDataFrame([(f.getPath().toString(),) for f in found if f.isDirectory()], "path string")
    return paths.select(strip_extension(F.col("path")).alias("run"), "path", F.regexp_extract("path", r"\.([^./]*)$", 1).alias("kind"))


def manifest(spark: SparkSession, pattern: str) -> DataFrame:
    """(run, path, kind) of files that match a glob; contents are not read."""
    files = spark.read.format("binaryFile").load(pattern).select("path")
    return files.select(strip_extension(F.col("path")).alias("run"), "path", F.regexp_extract("path", r"\.([^./]*)$", 1).alias("kind"))


def search_parameters(spark: SparkSession, path: str) -> DataFrame:
    """(name, value) of ``key = value # comment`` lines."""
    lines = spark.read.text(path).select(F.regexp_replace("value", "#.*$", "").alias("line"))
    m = lambda k: F.trim(F.regexp_extract("line", r"^\s*([A-Za-z_][\w\[\]]*)\s*=\s*(.*)$", k))
    return lines.select(m(1).alias("name"), m(2).alias("value")).where("name <> ''")


def parameter_sections(spark: SparkSession, path: str) -> DataFrame:
    """(section, nth, line): the lines of the ``[SECTION]`` tables that end a parameter file, comments left out; each file is read whole."""
    parts = spark.read.text(path, wholetext=True).select(F.explode(F.split("value", r"(?m)^[ \t]*\[(?=[^\]\n]*\][ \t]*\r?$)")).alias("part")).where(F.col("part").rlike(r"^[^\]\n]*\][ \t]*\r?(\n|$)"))
    lines = parts.select(F.substring_index("part", "]", 1).alias("section"), F.posexplode(F.split(F.regexp_replace("part", r"^[^\n]*\n?", ""), r"\r?\n")).alias("nth", "line"))
    return lines.withColumn("line", F.trim(F.regexp_replace("line", "#.*$", ""))).where("line <> ''")


def sp_embl(spark: SparkSession, path: str) -> DataFrame:
    """(entry, accession, description, sequence) of SP-EMBL texts: lines that begin with a code, entries that end with ``//``."""
    entries = spark.read.option("lineSep", "\n//").text(path).where(F.col("value").rlike(r"(?m)^ID   "))
    field = lambda code, pattern: F.regexp_extract("value", rf"(?m)^{code}   {pattern}", 1)
    residues = F.regexp_extract("value", r"(?s)\nSQ   [^\n]*\n(.*)$", 1)
    return entries.select(field("ID", r"(\S+)").alias("entry"), field("AC", r"([^;\s]+)").alias("accession"), field("DE", r"(.*?)\s*$").alias("description"), F.regexp_replace(residues, r"[^A-Za-z]", "").alias("sequence"))


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """(header, sequence)."""
    entries = spark.read.option("lineSep", ">").text(path).where("trim(value) <> ''")
    head = F.substring_index("value", "\n", 1)
    return entries.select(F.trim(head).alias("header"), F.regexp_replace(F.substring(F.col("value"), F.length(head) + 1, F.length("value")), r"\s", "").alias("sequence"))
