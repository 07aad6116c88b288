"""Cleaning of ids and names, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_version(gene: Column, numeric_only: bool = False) -> Column:
    """Id without version: up to the first dot, or without a last dot and digits."""
    return F.regexp_replace(gene, r"\.\d+$", "") if numeric_only else F.substring_index(gene, ".", 1)


def safe_name(name: Column) -> Column:
    """Characters other than letters, digits, dot, underscore and hyphen become underscores."""
    return F.regexp_replace(name, "[^A-Za-z0-9._-]", "_")


def comma_list(text: Column) -> Column:
    """Distinct trimmed items of a comma list, blanks left out, in order; null stays null."""
    return F.array_distinct(F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != ""))


def decimal_comma(text: Column) -> Column:
    """Number written with a decimal comma; null where it is none."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def reverse_complement(seq: Column) -> Column:
    """Reverse complement of ACGT text; other letters stay as they are."""
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


#: File endings, and marks of the first mate, in the order they are tried (fixed values).
FASTQ_ENDINGS = (".fastq.gz", ".fq.gz", ".fastq", ".fq", ".gz")
MATE_MARKS = ("_R1_001", "_R1", "_1", ".mate1")
#: Ends of the names of first and second mates, in the order they are tried (fixed values).
PAIR_MARKS = (("_1_val_1", "_2_val_2"), ("_R1_001", "_R2_001"), ("_R1", "_R2"), ("_1", "_2"), (".mate1", ".mate2"))
REPORT_ENDINGS = (".kraken2.report.txt", ".report.txt", ".k2report", ".kreport", ".report", ".txt")


def _ending(name: Column, endings: tuple[str, ...], shorter: bool) -> Column:
    """The name without the first of ``endings`` that it has; a name that is one stays if ``shorter``."""
    out = name
    for e in reversed(endings):
        fits = name.endswith(e) & ((F.length(name) > len(e)) if shorter else F.lit(True))
        out = F.when(fits, F.substring(name, F.lit(1), F.length(name) - len(e))).otherwise(out)
    return out


def fastq_sample(file: Column, paired: bool) -> Column:
    """Sample of a FASTQ file: without its ending and, of pairs, without the first mate's mark."""
    name = _ending(F.element_at(F.split(file, "/"), -1), FASTQ_ENDINGS, True)
    return _ending(name, MATE_MARKS, False) if paired else name


def report_sample(file: Column, endings: tuple[str, ...] = REPORT_ENDINGS) -> Column:
    """Sample of a report: its file name without the longest ending that it has."""
    return _ending(F.element_at(F.split(file, "/"), -1), tuple(sorted(endings, key=len, reverse=True)), True)


def syntactic_name(name: Column) -> Column:
    """A name that is a valid identifier in statistics software: other characters become dots.

    A name that begins with a digit, an underscore, or a dot and a digit gets an X.
    """
    plain = F.regexp_replace(name, "[^A-Za-z0-9._]", ".")
    return F.when((plain == "") | plain.rlike(r"^([0-9_]|\.[0-9])"), F.concat(F.lit("X"), plain)).otherwise(plain)


def grouped_number(text: Column) -> Column:
    """Whole number written with commas between groups of digits; null where it is none."""
    return F.replace(F.trim(text), F.lit(","), F.lit("")).try_cast("long")


def percent_number(text: Column) -> Column:
    """Number before a percent sign; null where it is none."""
    return F.rtrim(F.trim(text), F.lit("% ")).try_cast("double")
