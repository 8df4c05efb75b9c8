"""Name, key and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First words of file names that belong to a platform, not to an author.
PLATFORM_WORDS = [
    "10xgenomics", "vizgen", "nanostring", "akoya", "codex", "slideseq", "stereo", "resolve", "seqfish", "merscope",
]


def cell_key(first: Column, second: Column, sep: str = "__") -> Column:
    """``first__second`` from trimmed parts."""
    return F.concat(F.trim(first.cast("string")), F.lit(sep), F.trim(second.cast("string")))


def padded_fov(fov: Column, width: int = 3) -> Column:
    """``fov_007``; longer numbers keep all their digits."""
    digits = fov.cast("string")
    return F.concat(F.lit("fov_"), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def sample_from_title(title: Column, stem: Column) -> Column:
    """The word after ``sample`` at the end of the title, else the first eight characters of the stem."""
    found = F.regexp_extract(title, r"sample\s+(\S+)$", 1)
    return F.when(found != "", found).otherwise(F.substring(stem, 1, 8))


def folder_name(name: Column, max_len: int = 80) -> Column:
    """A readable folder name: special characters dropped, blanks to ``_``, cut, no trailing ``_``."""
    kept = F.regexp_replace(F.regexp_replace(name, r"^\s+|\s+$", ""), r"[^\p{L}\p{N}_\s\-]", "")
    joined = F.regexp_replace(kept, r"\s+", "_")
    return F.regexp_replace(F.substring(joined, 1, max_len), "_+$", "")


def query_from_stem(stem: Column) -> Column:
    """Search text of an author-named file; null for platform names and leading digits."""
    clean = F.replace(stem, F.lit("-"), F.lit("_"))
    first = F.split(clean, "_")[0]
    unusable = first.rlike(r"^\d") | first.rlike("(?i)^(" + "|".join(PLATFORM_WORDS) + ")")
    return F.when(~unusable, F.replace(clean, F.lit("_"), F.lit(" ")))


def first_token(column: Column, sep: str = ";") -> Column:
    return F.trim(F.split(column, sep)[0])


def tokens(column: Column, sep: str = ";") -> Column:
    """All trimmed tokens as an array."""
    return F.transform(F.split(column, sep), lambda t: F.trim(t))


def orientation(name: Column) -> Column:
    low = F.lower(name)
    return (
        F.when(low.contains("coronal"), "coronal")
        .when(low.contains("sagittal") | low.contains("sagital"), "sagittal")
        .otherwise("unknown")
    )


def accession(sample_id: Column) -> Column:
    """``GSM<digits>`` in front of the first underscore, else null."""
    found = F.regexp_extract(sample_id, r"^(GSM\d+)_(.+)$", 1)
    return F.when(found != "", found)


def specimen(sample_id: Column) -> Column:
    """What follows the accession, else the whole name."""
    found = F.regexp_extract(sample_id, r"^(GSM\d+)_(.+)$", 2)
    return F.when(found != "", found).otherwise(sample_id)


def platform(sample_id: Column) -> Column:
    return F.when(sample_id.contains("_HD_"), "Visium HD").otherwise("Visium")


def short_count(n: Column) -> Column:
    """1.23M, 4.5k or the number itself; halves round up."""
    n = n.cast("long")
    millions = F.floor((n * 100 + 500_000) / 1_000_000) / 100
    thousands = F.floor((n * 10 + 500) / 1_000) / 10
    return (
        F.when(n >= 1_000_000, F.format_string("%.2fM", millions))
        .when(n >= 1_000, F.format_string("%.1fk", thousands))
        .otherwise(n.cast("string"))
    )


def fixed_text(column: Column, decimals: int, signed: bool = False, digits: int = 3) -> Column:
    """Text of a value first rounded to ``digits`` decimals; halves round away from zero."""
    shown = F.round(F.round(column, digits).cast(f"decimal(18,{digits})"), decimals)
    return F.format_string(f"%{'+' if signed else ''}.{decimals}f", shown.cast("double"))
