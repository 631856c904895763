"""Text cleaning and extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's \w and \d cover ASCII only unless this flag leads the pattern.
UNICODE = "(?U)"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_or_null(text: str | Column, pattern: str, group: int = 0) -> Column:
    """First match of ``pattern``, NULL when there is none."""
    return F.nullif(F.regexp_extract(_col(text), pattern, group), F.lit(""))


def first_match(text: str | Column, patterns: Sequence[tuple[str, int]]) -> Column:
    """The first pattern that matches wins; each comes with its group."""
    return F.coalesce(*[extract_or_null(text, p, g) for p, g in patterns])


def squeeze_blanks(text: str | Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(_col(text), r"\s+", " ")


def strip_control(text: str | Column) -> Column:
    """Remove tabs, carriage returns and line feeds."""
    bare = _col(text)
    # Not translate, which takes a text apart character by character; these are searched as bytes.
    for mark in "\t\r\n":
        bare = F.replace(bare, F.lit(mark), F.lit(""))
    return bare


def strip_bom(text: str | Column) -> Column:
    """Remove one leading byte-order mark."""
    return F.regexp_replace(_col(text), "^\\x{FEFF}", "")


def trim_chars(text: str | Column, chars: str = " ") -> Column:
    return F.btrim(_col(text), F.lit(chars))


def spaced_line(parts: Sequence[Column | str], trim: bool = True) -> Column:
    """NULL-skipping concatenation, then one blank between what is left.

    A plain string among ``parts`` is a separator and is always written.
    """
    pieces = [F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts]
    line = squeeze_blanks(F.concat(*pieces))
    return F.trim(line) if trim else line


def repair_decimal(text: str | Column, type_: str = "decimal(38,18)") -> Column:
    """First number in a text, with sign and exponent, that may use a decimal comma; NULL if none parses."""
    number = r"[-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?"
    return extract_or_null(F.replace(_col(text), F.lit(","), F.lit(".")), number).try_cast(type_)


def safe_cast(c: str | Column, type_: str) -> Column:
    return _col(c).try_cast(type_)


def split_number_unit(text: str | Column) -> tuple[Column, Column]:
    """Leading number (decimal comma accepted) and the text that follows it."""
    number = extract_or_null(text, r"(\d+[.,]?\d*)", 1)
    value = F.replace(number, F.lit(","), F.lit(".")).try_cast("double")
    return value, F.when(number.isNotNull(), F.regexp_extract(_col(text), r"\d+[.,]?\d*(.*)", 1))


def segment(text: str | Column, sep: str, n: int) -> Column:
    """``n``-th piece of a split text; negative counts from the end, NULL if absent."""
    pieces = F.split(_col(text), F.lit(rf"\Q{sep}\E"))
    return F.try_element_at(pieces, F.lit(n))


def join_segments(text: str | Column, sep_pattern: str = "\n|;", out: str = " | ") -> Column:
    """Split, join with another separator, lower, and close the last piece too."""
    return F.concat(F.lower(F.array_join(F.split(_col(text), F.lit(sep_pattern)), out)), F.lit(out.rstrip()))


def truncate(text: str | Column, width: int) -> Column:
    """Cut to one less than the column width, as the target tables expect."""
    return F.substring(_col(text), 1, width - 1)


def contains_any(text: str | Column, words: Sequence[str]) -> Column:
    """Whether any of the words occurs; no words means never."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(_col(text), F.lit(word))
    return found


def classify(text: str | Column, rules: Sequence[tuple[Sequence[str], str]]) -> Column:
    """Kind of the first rule with one of its words in the text, else NULL."""
    result = None
    for words, kind in rules:
        hit = contains_any(text, words)
        result = F.when(hit, kind) if result is None else result.when(hit, kind)
    return F.lit(None).cast("string") if result is None else result


def file_name(path: str | Column) -> Column:
    """Last part of a path written with either kind of slash."""
    return F.regexp_extract(_col(path), r"([^/\\]*)$", 1)


def file_stem(path: str | Column) -> Column:
    """File name up to its first dot."""
    return F.regexp_extract(file_name(path), r"^([^.]*)", 1)


def file_tail(path: str | Column, extension: str) -> Column:
    """File name if the path holds a folder and ends in ``.extension``, else NULL."""
    return extract_or_null(path, rf"[\\|/]([^\\|/]*\.{extension})", 1)


def url_tail_id(url: str | Column) -> Column:
    """Number after the last underscore of an address, NULL if it does not end so."""
    return extract_or_null(url, r"_(\d+)$", 1).try_cast("bigint")


def attribute(text: str | Column, label: str, value_pattern: str, end: str = r"\s*\|") -> Column:
    """Value written after ``label:`` up to the segment's end, NULL if absent."""
    return extract_or_null(text, rf"{UNICODE}{label}:\s*({value_pattern}){end}", 1)


def assemble_link(text: str | Column) -> tuple[Column, Column]:
    """Download address and file name described inside a sharing page's script."""
    # Fixed patterns of the sharing page.
    url = extract_or_null(text, r'"weblink_get".*?"stock".*?"count".*?"url":"(.*?)"\}', 1)
    token = extract_or_null(text, r'"dwl_token":"(.*?)"', 1)
    name = extract_or_null(text, r'"folders":.*?"list.*?"name":"(.*?)"', 1)
    return F.concat(url, F.lit("get/"), token, F.lit("/"), name), name
