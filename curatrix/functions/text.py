"""Text and number functions, Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Flag words, and the highest number that stands for an unknown size.
TRUE_WORDS = ("yes", "y", "true", "t", "1")
FALSE_WORDS = ("no", "n", "false", "f", "0")
SIZE_UNKNOWN = 999_999_999_999


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def trimmed(c: Column) -> Column:
    return F.regexp_replace(text(c), r"^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return trimmed(c) == ""


def is_kept(exclusion: Column) -> Column:
    """Kept rows say ``no``; anything else is a reason."""
    return F.lower(trimmed(exclusion)) == "no"


def normalize_text(c: Column) -> Column:
    """Underscores to spaces, white space squeezed and trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text(c), "_", " "), r"\s+", " "))


def normalize_scientific_name(c: Column) -> Column:
    squeezed = F.trim(F.regexp_replace(text(c), r"\s+", " "))
    return F.when(F.lower(squeezed).isin("nan", "none"), "").otherwise(squeezed)


def is_two_word_name(c: Column) -> Column:
    return F.size(F.split(normalize_scientific_name(F.regexp_replace(text(c), "_", " ")), " ")) >= 2


def species_token(name: Column, explicit: Column | None = None) -> Column:
    """A file-safe species key; an explicit non-blank token wins."""
    made = F.regexp_replace(F.regexp_replace(trimmed(name), r"[^0-9A-Za-z._-]", "_"), "_+", "_")
    made = F.regexp_replace(made, r"^[_.]+|[_.]+$", "")
    return made if explicit is None else F.when(~is_blank(explicit), trimmed(explicit)).otherwise(made)


def unique_values(values: Column) -> Column:
    """Ordered distinct non-empty trimmed values of an array."""
    return F.array_distinct(F.filter(F.transform(values, lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: x != ""))


def split_unique(c: Column, separator: str) -> Column:
    return unique_values(F.split(text(c), separator))


def to_flag(c: Column, default: bool | None = None) -> Column:
    word = F.lower(trimmed(c))
    other = F.raise_error(F.concat(F.lit("not a flag: "), word)).cast("boolean")
    blank = other if default is None else F.lit(default)
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False).when(word == "", blank).otherwise(other)


def to_number(c: Column) -> Column:
    """A finite double, else null."""
    v = c.try_cast("double")
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)


def finite(v: Column) -> Column:
    return F.when(F.isnan(v) | (F.abs(v) == float("inf")), None).otherwise(v)


def marker_species(file_name: Column) -> Column:
    """``Genus_species`` from the start of a marker-table file name."""
    return F.regexp_extract(file_name, r"([A-Z][A-Za-z-]*_[A-Za-z0-9-]+)", 1)


def read_file_stem(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, r"(?i)\.(fastq|fq)(\.gz)?$", ""), r"_[12]$", "")


def read_file_mate(name: Column) -> Column:
    return F.try_to_number(F.nullif(F.regexp_extract(F.regexp_replace(name, r"(?i)\.(fastq|fq)(\.gz)?$", ""), r"_([12])$", 1), F.lit("")), F.lit("9")).cast("int")


def read_core(header: Column) -> Column:
    """The first token of a header without its mate suffix."""
    return F.regexp_replace(F.regexp_replace(F.element_at(F.split(F.trim(header), r"\s+"), 1), "^@", ""), "/[12]$", "")


def read_mate(header: Column) -> Column:
    parts = F.split(F.trim(header), r"\s+")
    suffix = F.regexp_extract(F.element_at(parts, 1), "/([12])$", 1)
    second = F.regexp_extract(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), "^([12])(:|$)", 1)
    return F.when(suffix != "", suffix).when(second != "", second).cast("int")


def mate_header(core: Column, mate: Column) -> Column:
    return F.concat(F.lit("@"), core, F.lit("/"), mate.cast("string"))


def round_half_up(v: Column) -> Column:
    return F.floor(v + 0.5).cast("long")


def log_transform(v: Column, method: str) -> Column:
    """``logn``, ``log2``, ``lognp1``, ``log2p1`` or ``none``; the log of 0 is minus infinity."""
    if method == "none":
        return v
    shifted = v + 1.0 if method.endswith("p1") else v
    base = F.log2 if method.startswith("log2") else F.log
    return F.when(shifted == 0, float("-inf")).when(shifted < 0, None).otherwise(base(shifted))


def inverse_log(v: Column, method: str) -> Column:
    if method == "none":
        return v
    raw = F.pow(F.lit(2.0), v) if method.startswith("log2") else F.exp(v)
    return raw - 1.0 if method.endswith("p1") else raw


def safe_ratio_clip(corrected: Column, uncorrected: Column) -> Column:
    """corrected / uncorrected with 0 as missing, clipped to 0.5 .. 2."""
    ratio = F.try_divide(F.when(corrected != 0, corrected), F.when(uncorrected != 0, uncorrected))
    return F.when(ratio.isNotNull(), F.greatest(F.lit(0.5), F.least(F.lit(2.0), ratio)))


def archive_link(run: Column, experiment: Column, base: str) -> Column:
    """URL of a run's archive file from its accessions; null unless both look like accessions."""
    ok = run.rlike("^[DES]RR[0-9]{6,}$") & experiment.rlike("^[DES]RX[0-9]{6,}$")
    return F.when(ok, F.concat(F.lit(base), F.lit("/"), F.substring(experiment, 1, 3), F.lit("/"), F.substring(experiment, 1, 6), F.lit("/"), experiment, F.lit("/"), run, F.lit("/"), run, F.lit(".sra")))


def last_enabled(stages: list[tuple[str, Column]]) -> Column:
    """The value of the last stage (in order) that has one."""
    return F.coalesce(*[c for _, c in reversed(stages)])


def strip_special(c: Column) -> Column:
    return F.regexp_replace(c, "[\\r\\n'\"|]", "")


def sanitize(c: Column) -> Column:
    """Control characters to spaces, for delimited text."""
    return F.regexp_replace(c, r"[\x00-\x1f\x7f]+", " ")
