"""Expressions on product ids, file names and image pairs. A null argument gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats of product ids (fixed values): anywhere in a text, and in file names.
STRICT_ID = r"\b([MECS]\d{9,10}[RLMCVU]E)\b"
LOOSE_ID = r"M\d+[LR]E"
PAIR = r"(M\d+[LR]E)__(M\d+[LR]E)"


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def filename_to_pid(path: Column) -> Column:
    """The file name before its first dot."""
    return F.substring_index(basename(path), ".", 1)


def extract_pid(text: Column, strict: bool = True) -> Column:
    """The first product id; null if there is none (strict), else the file name before its first dot."""
    if strict:
        found = F.regexp_extract(text, STRICT_ID, 1)
        return F.when(found != "", found)
    found = F.regexp_extract(text, LOOSE_ID, 0)
    return F.when(found != "", found).otherwise(filename_to_pid(text))


def observation_id(pid: Column) -> Column:
    """The id without the last two characters, which name the side."""
    return F.substring(pid, F.lit(1), F.length(pid) - 2)


def pair_key(file: Column) -> Column:
    """``left__right`` in a file name, or null."""
    found = F.regexp_extract(file, PAIR, 0)
    return F.when(found != "", found)


def view_url(pid: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), pid)


def rewrite_path(pid: Column, folder: str, suffix: str) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), pid, F.lit(suffix))


def replace_suffix(path: Column, old: str, new: str) -> Column:
    cut = F.substring(path, F.lit(1), F.length(path) - len(old))
    return F.when(F.endswith(path, F.lit(old)), F.concat(cut, F.lit(new))).otherwise(path)


def canonical_pair(left: Column, right: Column) -> tuple[Column, Column]:
    """The smaller id first."""
    return F.least(left, right), F.greatest(left, right)


def product_id_from_archive(label: Column, archive: Column) -> Column:
    """The label's name without ``.xml``, else the archive's id without ``nac.``; upper case."""
    name = F.regexp_replace(label, r"(?i)\.xml$", "")
    return F.upper(F.when(F.coalesce(name, F.lit("")) != "", name).otherwise(F.regexp_replace(archive, r"^nac\.", "")))
