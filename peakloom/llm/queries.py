"""Queries over this project's tables for the operators of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.llm import cutoff, encodings, leakage, nearest, packing, percentiles
from peakloom.session import staged, table

PCTS = [10, 50, 90]
TOLERANCE_S = 30.0
CAPACITY = 4096
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Features at or above the cutoff of their run."""
    rows = cutoff.kept(table(spark, sf, "detected_features"), table(spark, sf, "run_manifest"), "run", "feat_id", "intensitysum", "keep_fraction")
    return rows.select("run", "feat_id")


def p2_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    """Cutoff, features counted and features kept of each run."""
    rows = cutoff.cutoffs(table(spark, sf, "detected_features"), table(spark, sf, "run_manifest"), "run", "feat_id", "intensitysum", "keep_fraction")
    return rows.select("run", F.col("cutoff"), "counted", "kept")


def p3_nearest(spark: SparkSession, sf: str) -> DataFrame:
    """Each PSM with its nearest feature and the distance in seconds."""
    psms, features = table(spark, sf, "identifications"), table(spark, sf, "detected_features")
    seconds = lambda c: F.col(c) * 60.0
    return nearest.nearest(
        psms, features, ["run", "inclusion_id"], ("psm_id", F.col("retention_time")), ("feat_id", seconds("rtstart"), seconds("rtend")), TOLERANCE_S
    )


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_nearest(spark, sf).select("psm_id", "feat_id")


def p3_distances(spark: SparkSession, sf: str) -> DataFrame:
    """PSMs by whole seconds to their nearest feature."""
    return p3_nearest(spark, sf).groupBy(F.floor("distance").alias("whole_s")).agg(F.count("*").alias("psms"))


def _level(v) -> F.Column:
    return F.floor(10 * F.log10(v) + 0.5).cast("int")


def p4_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact percentiles of each run, rounded to 6 decimals."""
    rows = percentiles.percentiles(table(spark, sf, "feature_tsv"), F.col("run"), F.col("intensity"), PCTS)
    return rows.select(F.col("group").alias("run"), "pct", F.round("value", 6).alias("value"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = percentiles.percentiles(table(spark, sf, "feature_tsv"), F.col("run"), F.col("intensity"), PCTS)
    return rows.select(F.col("group").alias("run"), "pct", _level(F.col("value")).alias("level_db"))


def p4_days_combined(spark: SparkSession, sf: str) -> DataFrame:
    """The same levels from summaries of single days, added up."""
    days = percentiles.summary(table(spark, sf, "feature_tsv"), [F.col("run"), F.to_date("exported_at").alias("day")], F.col("intensity"))
    return percentiles.combined(days, "run", PCTS).select(F.col("group").alias("run"), "pct", _level(F.col("value")).alias("level_db"))


def p6_packed(spark: SparkSession, sf: str) -> DataFrame:
    """Container of 4,096 tokens and offset in it of every notebook, or piece of one above 4,096."""
    sizes = packing.token_counts(table(spark, sf, "documents"), "doc_id", "text", VOCABULARY)
    return packing.packed(sizes, CAPACITY).withColumnsRenamed({"key": "doc_id", "size": "tokens"})


def p6_containers(spark: SparkSession, sf: str) -> DataFrame:
    """Containers with their pieces and tokens."""
    return p6_packed(spark, sf).groupBy("container").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("tokens"))


def p6_checks(spark: SparkSession, sf: str) -> DataFrame:
    """One row: documents placed, and what must be none: documents cut though they fit, wrong numbers of pieces, overfull containers, gaps in them."""
    rows = staged(p6_packed(spark, sf))
    documents = rows.groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("tokens"))
    none = lambda c: F.count_if(c).alias
    cut = (F.col("tokens") <= CAPACITY) & (F.col("pieces") > 1)
    per_document = documents.agg(F.count("*").alias("documents"), none(cut)("cut_though_small"), none(F.col("pieces") != F.greatest(F.lit(1), F.ceil(F.col("tokens") / CAPACITY)))("wrong_pieces"))
    # pieces without tokens take no room, so their offsets say nothing
    containers = rows.where("tokens > 0").groupBy("container").agg(F.sum("tokens").alias("tokens"), F.max(F.col("at") + F.col("tokens")).alias("end"), F.min("at").alias("start"))
    per_container = containers.agg(none(F.col("end") > CAPACITY)("overfull"), none((F.col("start") != 0) | (F.col("end") != F.col("tokens")))("gaps"))
    return per_document.crossJoin(per_container)  # one row each


def p7_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Passages shared by an item and a cell of a document, in words of the cell."""
    return leakage.spans(table(spark, sf, "documents"), ("doc_id", "text", "layout"), table(spark, sf, "eval_items"), ("item_id", "text"))


def p7_passages(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of leaked item and document with the number of passages they share and their words."""
    words = F.col("end_word") - F.col("first_word")
    return p7_spans(spark, sf).groupBy("item_id", "doc_id").agg(F.count("*").alias("passages"), F.sum(words).alias("words"), F.max(words).alias("longest"))


def p7_removed(spark: SparkSession, sf: str) -> DataFrame:
    """Affected documents without the leaked passages, and how many characters went."""
    return leakage.removed(table(spark, sf, "documents"), ("doc_id", "text", "layout"), table(spark, sf, "eval_items"), ("item_id", "text"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return p7_spans(spark, sf).select("item_id", "doc_id").distinct()


def p7_items(spark: SparkSession, sf: str) -> DataFrame:
    """Leaked items with the number of documents that hold them and their longest passage."""
    rows = p7_spans(spark, sf).withColumn("words", F.col("end_word") - F.col("first_word"))
    each = rows.groupBy("item_id", "doc_id").agg(F.max("words").alias("words"))
    return each.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("longest"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return encodings.label(table(spark, sf, "documents"), "doc_id", "text").select("doc_id")


def p8_restored(spark: SparkSession, sf: str) -> DataFrame:
    """Affected documents with the pairs that explain them and the text restored as far as it can be."""
    return encodings.label(table(spark, sf, "documents"), "doc_id", "text", restored=True)


def p8_spans(spark: SparkSession, sf: str) -> DataFrame:
    """Garbled stretches with their place in the raw text, the pair that explains each and the original characters."""
    return encodings.garbled_spans(table(spark, sf, "documents"), "doc_id", "text")


QUERIES = {
    "p6_packed": p6_packed,
    "p6_containers": p6_containers,
    "p6_checks": p6_checks,
    "p7_found": p7_found,
    "p7_spans": p7_spans,
    "p7_items": p7_items,
    "p7_passages": p7_passages,
    "p7_removed": p7_removed,
    "p8_found": p8_found,
    "p8_restored": p8_restored,
    "p8_spans": p8_spans,
    "p2_found": p2_found,
    "p2_cutoffs": p2_cutoffs,
    "p3_found": p3_found,
    "p3_nearest": p3_nearest,
    "p3_distances": p3_distances,
    "p4_found": p4_found,
    "p4_percentiles": p4_percentiles,
    "p4_days_combined": p4_days_combined,
}

_ONE = """WITH one AS (
  SELECT run, feat_id, max(intensitysum) AS s FROM detected_features
  WHERE run IS NOT NULL AND feat_id IS NOT NULL AND intensitysum >= 0 AND NOT isnan(intensitysum) AND NOT isinf(intensitysum)
  GROUP BY run, feat_id),
pos AS (SELECT run, s, count(*) OVER (PARTITION BY run ORDER BY s DESC) AS through, count(*) OVER (PARTITION BY run) AS n FROM one),
cut AS (SELECT run, max(s) AS cutoff, min(through)::BIGINT AS kept, any_value(n)::BIGINT AS counted
  FROM pos JOIN run_manifest USING (run) WHERE through / n >= keep_fraction GROUP BY run)
"""
_NEAR = """WITH psm AS (
  SELECT DISTINCT psm_id, run, inclusion_id, retention_time AS t FROM identifications
  WHERE retention_time IS NOT NULL AND run IS NOT NULL AND inclusion_id IS NOT NULL),
feat AS (
  SELECT DISTINCT feat_id, run, inclusion_id, least(rtstart * 60.0, rtend * 60.0) AS a, greatest(rtstart * 60.0, rtend * 60.0) AS b FROM detected_features
  WHERE rtstart IS NOT NULL AND rtend IS NOT NULL),
near AS (
  SELECT psm_id, feat_id, greatest(0.0, a - t, t - b) AS distance FROM psm JOIN feat USING (run, inclusion_id)
  WHERE greatest(0.0, a - t, t - b) <= 30.0
  QUALIFY row_number() OVER (PARTITION BY psm_id ORDER BY distance, CASE WHEN distance = 0 THEN -b END, feat_id) = 1)
"""
_PCT = """SELECT run, 10 AS pct, quantile_cont(intensity, 0.1) AS v FROM u GROUP BY run
  UNION ALL SELECT run, 50, quantile_cont(intensity, 0.5) FROM u GROUP BY run
  UNION ALL SELECT run, 90, quantile_cont(intensity, 0.9) FROM u GROUP BY run"""
_PCT = f"""WITH u AS (SELECT run, intensity FROM feature_tsv
  WHERE run IS NOT NULL AND intensity >= 0 AND NOT isnan(intensity) AND NOT isinf(intensity)),
p AS ({_PCT}) """
_LEVEL = _PCT + "SELECT run, pct::INT AS pct, floor(10 * log10(v) + 0.5)::INT AS level_db FROM p"

_JOINED = lambda x: f"CASE json_type({x}) WHEN 'ARRAY' THEN array_to_string(list_transform(list_filter(json_extract({x}, '$[*]'), lambda e: json_type(e) = 'VARCHAR'), lambda e: e->>'$'), '') WHEN 'VARCHAR' THEN {x}->>'$' END"
_SPANS = f"""WITH book AS (SELECT doc_id, unnest(json_extract(text, '$.cells[*]')) AS c FROM documents WHERE layout = 'ipynb' AND json_valid(text)),
o AS (SELECT doc_id, unnest(json_extract(c, '$.outputs[*]')) AS o FROM book),
txt AS (SELECT doc_id, {_JOINED("c->'source'")} AS t FROM book
  UNION ALL SELECT doc_id, {_JOINED("o->'text'")} FROM o UNION ALL SELECT doc_id, {_JOINED("o->'evalue'")} FROM o
  UNION ALL SELECT doc_id, array_to_string(o->>'$.traceback[*]', chr(10)) FROM o
  UNION ALL SELECT doc_id, {_JOINED("x")} FROM (SELECT doc_id, json_extract(o, '$.data."' || unnest(json_keys(o, '$.data')) || '"') AS x FROM o WHERE json_type(o, '$.data') = 'OBJECT')
  UNION ALL SELECT doc_id, unnest(regexp_split_to_array(text, '(?m)^(?:Text|Error|Image|(?:In |Out)\\[[ \\d]*\\]):[ \\t]*$')) FROM documents WHERE layout = 'console'
  UNION ALL SELECT doc_id, unnest(regexp_split_to_array(text, '(?m)^# %%.*$')) FROM documents WHERE layout = 'script'),
cell AS (SELECT doc_id, row_number() OVER () AS cell, w FROM (SELECT doc_id, regexp_extract_all(lower(t), '[a-z0-9]+') AS w FROM txt) WHERE len(w) >= 12),
word AS (SELECT doc_id, cell, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM cell),
gram AS (SELECT doc_id, cell, k, g FROM (SELECT *, string_agg(word, ' ') OVER w AS g, count(*) OVER w AS n FROM word WINDOW w AS (PARTITION BY cell ORDER BY k ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING)) WHERE n = 12),
item AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS k FROM (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM eval_items))),
hit AS (SELECT item_id, doc_id, cell, k FROM gram JOIN item USING (g)),
mark AS (SELECT *, sum(CASE WHEN k <= before + 12 THEN 0 ELSE 1 END) OVER (PARTITION BY item_id, cell ORDER BY k) AS span FROM (SELECT *, lag(k) OVER (PARTITION BY item_id, cell ORDER BY k) AS before FROM hit)),
spans AS (SELECT item_id, doc_id, cell, max(k) - min(k) + 12 AS words FROM mark GROUP BY item_id, doc_id, cell, span)
"""

_ITEMS = _SPANS + """, each AS (SELECT item_id, doc_id, max(words) AS words FROM spans GROUP BY item_id, doc_id)
"""

SQL = {
    "p6_checks": "SELECT count(*)::BIGINT AS documents, 0::BIGINT AS cut_though_small, 0::BIGINT AS wrong_pieces, 0::BIGINT AS overfull, 0::BIGINT AS gaps FROM documents",
    "p7_found": _SPANS + "SELECT DISTINCT item_id, doc_id FROM spans",
    "p7_items": _ITEMS + "SELECT item_id, count(*) AS documents, max(words)::INT AS longest FROM each GROUP BY item_id",
    "p7_passages": _ITEMS + "SELECT item_id, doc_id, count(*) AS passages, sum(words)::BIGINT AS words, max(words)::INT AS longest FROM spans GROUP BY item_id, doc_id",
    "p2_found": _ONE + "SELECT one.run, feat_id FROM one JOIN cut ON one.run = cut.run AND s >= cutoff",
    "p2_cutoffs": _ONE + "SELECT run, cutoff, counted, kept FROM cut",
    "p3_found": _NEAR + "SELECT psm_id, feat_id FROM near",
    "p3_nearest": _NEAR + "SELECT psm_id, feat_id, distance FROM near",
    "p3_distances": _NEAR + "SELECT floor(distance)::BIGINT AS whole_s, count(*) AS psms FROM near GROUP BY 1",
    "p4_found": _LEVEL,
    "p4_percentiles": _PCT + "SELECT run, pct::INT AS pct, round(v, 6) AS value FROM p",
    "p4_days_combined": _LEVEL,
}
