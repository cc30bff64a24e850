"""Column builders for headers, labels, sequences and numbers. All are built-in expressions.

Names of columns given as text must not be those of the lambda variables: _i, _o, _p, _s, _x.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of headers, file names and identifiers.
DEFLINE = r"^(\S+)\s*(.*?)\s*(?:\[([^\]]+)\])?\s*$"
STEM = r"^(\S+)\s+(.+?)\s+-\s+(.+)$"
EPITOPE_ID = r"^(.+)_(B_cell|T_cell)_([A-Za-z0-9-]+)_(\d+)\.(\d+)$"
# The twenty standard residues, and those that a record may hold.
STANDARD = "ACDEFGHIKLMNPQRSTVWY"
VALID = "ACDEFGHIKLMNPQRSTVWYBXZJUO"
# Antigenic propensities by residue.
PROPENSITY = {"A": 1.064, "C": 1.412, "D": 0.866, "E": 0.851, "F": 1.091, "G": 0.874, "H": 1.105, "I": 1.152, "K": 0.930, "L": 1.250, "M": 0.826, "N": 0.776, "P": 1.064, "Q": 1.015, "R": 0.873, "S": 1.012, "T": 0.909, "V": 1.383, "W": 0.893, "Y": 1.161}


def record_id(header: Column) -> Column:
    return F.split(header, r"\s+")[0]


def defline(header: Column) -> list[Column]:
    return [F.regexp_extract(header, DEFLINE, i + 1).alias(n) for i, n in enumerate(("accession", "name", "strain"))]


def fallback(value: Column, stem: Column, part: int, unknown: str) -> Column:
    """A header's part, else that of the file's name, else a fixed name."""
    return F.coalesce(F.nullif(value, F.lit("")), F.nullif(F.regexp_extract(stem, STEM, part), F.lit("")), F.lit(unknown))


def slug(x: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(F.trim(x), r"[^\p{L}\p{Nd}]+", "_"), F.lit("_")), F.lit("")), F.lit("unknown"))


def header_of(*parts: Column) -> Column:
    return F.concat_ws("|", *(F.regexp_replace(F.trim(x), r"\s+", "_") for x in parts))


def header_parts(x: Column) -> list[Column]:
    return [F.coalesce(F.get(F.split(x, r"\|"), F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(("protein", "strain", "accession"))]


def number_text(x: Column) -> Column:
    """At most six decimals, no trailing zeros; null stays null."""
    return F.when(x.isNotNull(), F.rtrim(F.rtrim(F.format_string("%.6f", x), F.lit("0")), F.lit(".")))


def as_bool(x: Column) -> Column:
    return F.lower(F.trim(x)).isin("true", "t", "yes", "y", "1")


def as_float(x: Column, default: float = float("nan")) -> Column:
    """A number, or the default where the text is none; NaN unless another is given."""
    return F.coalesce(F.trim(x).try_cast("double"), F.lit(default))


def as_int(x: Column, default: int = 0) -> Column:
    return F.coalesce(x.try_cast("double").try_cast("int"), F.lit(default))


_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def folded(x: Column) -> Column:
    """a-z as A-Z. Letters beyond are no residues and stay, so that no text changes its length."""
    return F.translate(x, _LOWER, _UPPER)


def match_text(window: Column, ref_id: Column, offset: Column) -> Column:
    """A place in a reference, counted from 1."""
    return F.format_string("%s@%s:%d", window, ref_id, offset + 1)


def windows(x: Column, k: int) -> Column:
    """All k-character windows in upper case; a shorter text is its own window, an empty one has none."""
    every = F.regexp_extract_all(folded(x), F.lit(f"(?s)(?=(.{{{k}}}))"), 1)
    return F.when(F.length(x) == 0, F.array().cast("array<string>")).when(F.length(x) < k, F.array(folded(x))).otherwise(every)


def standard_only(x: Column) -> Column:
    return x.rlike(f"^[{STANDARD}]+$")


def _matches(query: str, target: str, at: str) -> str:
    return f"aggregate(transform(sequence(1, length({query})), _i -> if(substr({query}, _i, 1) = substr({target}, {at} + _i, 1), 1, 0)), 0, (_s, _x) -> _s + _x)"


def _placed(query: str, target: str) -> str:
    """Most matches over the placements of query inside target (at least as long)."""
    return f"array_max(transform(sequence(0, length({target}) - length({query})), _o -> {_matches(query, target, '_o')}))"


def percent_identity(a: str, b: str) -> Column:
    """Ungapped, the shorter inside the longer, over the longer's length; a contained text scores 99.9."""
    short, long = f"if(length({a}) <= length({b}), {a}, {b})", f"if(length({a}) <= length({b}), {b}, {a})"
    return F.expr(f"case when length({a}) = 0 or length({b}) = 0 then 0D when contains({long}, {short}) then 99.9D else {_placed(short, long)} * 100D / length({long}) end")


def max_identity_matches(query: str, target: str) -> Column:
    return F.expr(f"case when length({query}) = 0 or length({target}) < length({query}) then 0 else {_placed(query, target)} end")


def window_identity(query: str, target: str) -> Column:
    """Best fraction of matches; a shorter target is compared from its start."""
    over = f"aggregate(transform(sequence(1, length({target})), _i -> if(substr({query}, _i, 1) = substr({target}, _i, 1), 1, 0)), 0, (_s, _x) -> _s + _x)"
    return F.expr(f"case when length({query}) = 0 or length({target}) = 0 then 0D when contains({target}, {query}) then 1D when length({target}) < length({query}) then {over} * 1D / length({query}) else {_placed(query, target)} * 1D / length({query}) end")


def best_offset(peptide: str, anchor: str) -> Column:
    """Offset of peptide against anchor with most matches, then most overlap, then nearest, then negative."""
    lo, hi = "greatest(0, _o)", f"least(length({anchor}), _o + length({peptide}))"
    score = f"if({hi} <= {lo}, 0, aggregate(transform(sequence({lo}, greatest({lo}, {hi} - 1)), _p -> if(substr({anchor}, _p + 1, 1) = substr({peptide}, _p - _o + 1, 1), 1, 0)), 0, (_s, _x) -> _s + _x))"
    return F.expr(f"-(array_max(transform(sequence(1 - length({peptide}), length({anchor}) - 1), _o -> struct({score} as a, {hi} - {lo} as b, -abs(_o) as c, -_o as d))).d)")


def propensity(residue: Column) -> Column:
    pairs = [y for k, v in PROPENSITY.items() for y in (F.lit(k), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), residue)


def is_threshold_range(spec: Column) -> Column:
    """Whether threshold_sweep accepts a text."""
    high, low = _ends(spec)
    return spec.rlike(r"^\s*[0-9]+(\.[0-9]+)?\s*(:\s*[0-9]+(\.[0-9]+)?\s*)?$") & F.coalesce((high <= 100) & (low <= 100) & (high > 1) & (low > 1) & (F.floor(high) >= F.floor(low)), F.lit(False))


def thresholds_of(spec: Column, step: int = 10) -> Column:
    """threshold_sweep of a column; null where it would be an error."""
    high, low = (F.floor(x).cast("int") for x in _ends(spec))
    return F.when(is_threshold_range(spec), F.array_union(F.sequence(high, low, F.lit(-step)), F.array(low)))


def _ends(spec: Column) -> tuple[Column, Column]:
    parts = F.split(spec, ":")
    return tuple(F.trim(p).try_cast("double") for p in (parts[0], F.element_at(parts, -1)))


def threshold_sweep(spec: str | int, step: int = 10) -> list[int]:
    """'90:50' -> 90, 80, ... 50; one number is itself. The last value always takes part."""
    parts = str(spec).split(":")
    if len(parts) > 2 or not all(re.fullmatch(r"\s*\d+(\.\d+)?\s*", p) for p in parts):
        raise ValueError(f"not a threshold range: {spec!r}")
    ends = [float(p) for p in parts]
    if any(e <= 1 or e > 100 for e in ends):
        raise ValueError("thresholds are per cent, over 1 and up to 100")
    high, low = int(ends[0]), int(ends[-1])
    if high < low:
        raise ValueError("a range runs from the higher to the lower threshold")
    return [*range(high, low, -step), low]
