"""Column expressions shared by the plans; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "_____"
METHODS = ("maximum", "sum", "top3_sum", "top3_mean")


def array_median(a: Column) -> Column:
    """Median of an array's non-null members, the mean of the middle two for an even number; null if there are none."""
    s = F.array_sort(F.filter(a, lambda x: x.isNotNull()))
    n = F.size(s)
    at = lambda k: F.try_element_at(s, k.cast("int"))
    return F.when(n > 0, (at(F.floor((n + 1) / 2)) + at(F.floor((n + 2) / 2))) / 2)


def trapezoid(points: Column, x: str, y: str) -> Column:
    """Area under an array of structs in order; 0 for none or one."""
    start = F.struct(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), F.lit(0.0).alias("a"))

    def step(acc: Column, p: Column) -> Column:
        area = F.coalesce((p[x] - acc.x) * (p[y] + acc.y) / 2, F.lit(0.0))
        return F.struct(p[x].alias("x"), p[y].alias("y"), (acc.a + area).alias("a"))

    return F.aggregate(points, start, step, lambda acc: acc.a)


def rollup(areas: Column, method: str) -> Column:
    """One intensity of a feature from the areas of its isotopes; null for none."""
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda s, v: s + v)
    top = F.slice(F.sort_array(areas, asc=False), 1, 3)
    if method == "maximum":
        return F.array_max(areas)
    if method == "sum":
        return F.when(F.size(areas) > 0, add(areas))
    if method == "top3_sum":
        return F.when(F.size(areas) > 0, add(top))
    if method == "top3_mean":
        return F.when(F.size(areas) > 0, add(top) / F.size(top))
    raise ValueError(f"unknown method: {method}")


def ppm(mz: Column, tolerance: float) -> Column:
    return mz / 1000000 * tolerance


def run_key(name: Column) -> Column:
    """File name up to the separator."""
    return F.substring_index(name, SEPARATOR, 1)


def fdr_key(name: Column) -> Column:
    """The four characters after ``fdr_``; null where the name has none."""
    return F.nullif(F.regexp_extract(name, "fdr_(.{4})", 1), F.lit(""))


def strip_extension(path: Column) -> Column:
    """Base name without its last extension."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def scan_number(native_id: Column) -> Column:
    """Number after ``scan`` and one character, up to the next space; null if it is none."""
    return F.regexp_extract(native_id, "scan.([^ ]*)", 1).try_cast("int")


def hill_list(isotopes: Column) -> Column:
    """Hill numbers in the text of a list of dicts, in order; null for a null text."""
    found = F.regexp_extract_all(isotopes, F.lit(r"isotope_hill_idx\D{1,4}(\d+)"), 1)
    return F.transform(found, lambda x: x.try_cast("bigint"))


def int_list(text: Column) -> Column:
    """Integers in a list's text, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), 1), lambda x: x.try_cast("bigint"))


_CALL, _NOTHING = r"\b(?:np|numpy)\.\w+\(([^()\[\]]*)\)", r"(?<=[\[,\s])(?:None|nan|NaN)(?=[\],\s])"


def text_list(text: Column) -> Column:
    """Strings of a list's text, null members for ``None`` and ``nan``; null if it is no list."""
    return F.from_json(F.regexp_replace(text, _NOTHING, "null"), "array<string>")


def number_list(text: Column) -> Column:
    """Numbers of a flat list's text at their positions, null where there is no finite one; null if it is no list."""
    plain = F.trim(F.when(F.contains(text, F.lit("np.")) | F.contains(text, F.lit("numpy.")), F.regexp_replace(text, _CALL, "$1")).otherwise(text))
    inner = F.rtrim(F.translate(plain, "[]()'\"", ""))
    parts = F.split(F.when(inner.endswith(","), F.substring(inner, F.lit(1), F.length(inner) - 1)).otherwise(inner), ",")
    number = lambda x: F.when(F.abs(x) < float("inf"), x)
    numbers = F.transform(parts, lambda x: number(F.trim(x).try_cast("double")))
    ends = lambda a, b: plain.startswith(a) & plain.endswith(b)
    return F.when(ends("[", "]") | ends("(", ")"), F.when(inner == "", F.array().cast("array<double>")).otherwise(numbers))


def holds_any(texts: Column) -> Column:
    """Whether a list has a member that is not null; false for a null list."""
    return F.coalesce(F.exists(texts, lambda x: x.isNotNull()), F.lit(False))


def stable_id(*parts: Column) -> Column:
    """An id that depends on nothing but the parts."""
    return F.xxhash64(*parts)


def is_peptide(sequence: Column) -> Column:
    """Whether a sequence consists of plain residues."""
    return F.coalesce(sequence.rlike("^[A-Z]+$"), F.lit(False))


def cutoff_spec(spec: str) -> tuple[str, float]:
    """``t1000``: absolute; ``q0.05``: quantile between 0 and 1."""
    kind, number = spec[:1], float(spec[1:] or "nan")
    if kind not in ("t", "q") or number != number:
        raise ValueError(f"a cutoff is t or q and a number: {spec}")
    if kind == "q" and not 0 <= number <= 1:
        raise ValueError(f"a quantile lies between 0 and 1: {spec}")
    return kind, number
