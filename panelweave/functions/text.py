"""Text rules for names, codes and units."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean(c: Column) -> Column:
    """Trimmed text, null as the empty string."""
    return F.trim(F.coalesce(c, F.lit("")))


def unquote(c: Column) -> Column:
    """Trim, then drop surrounding double quotes."""
    return F.regexp_replace(F.trim(c), r'^"+|"+$', "")


def bare_code(c: Column) -> Column:
    """Drop the leading apostrophes of spreadsheet-protected codes."""
    return F.regexp_replace(c, r"^'+", "")


def strip_footnote(c: Column) -> Column:
    """The words of a label without the asterisks at its end, one blank apart."""
    words = F.filter(F.split(F.rtrim(c, F.lit("* \t\n\r")), r"\s"), lambda w: w != "")
    return F.array_join(words, " ")


def unwrap(c: Column) -> Column:
    """The inside of a unit in parentheses; other text is only trimmed."""
    text = F.trim(F.coalesce(c, F.lit("")))
    return F.when(text.rlike(r"^\(.*\)$"), F.trim(F.regexp_extract(text, r"^\((.*)\)$", 1))).otherwise(text)


def label(code: Column, name: Column) -> Column:
    return F.concat_ws(" ", code, name)


def label_code(c: Column) -> Column:
    """The code back out of ``"<code> <name>"``."""
    return F.split_part(c, F.lit(" "), F.lit(1))


def title_code(c: Column, width: int) -> Column:
    """A code padded with zeros on the left."""
    return F.lpad(c.cast("string"), width, "0")


def brace_names(c: Column) -> Column:
    """``"fao_{a,b}_t"`` to the array of names it stands for; plain names give themselves."""
    head, body, tail = (F.regexp_extract(c, r"^([^{]*)\{([^}]*)\}(.*)$", i) for i in (1, 2, 3))
    many = F.transform(F.split(body, ","), lambda part: F.concat(head, F.trim(part), tail))
    return F.when(c.contains("{"), many).otherwise(F.array(c))


def _plain(c: str) -> str:
    """What a character leaves in ASCII once its accents and its compatibility form are taken apart."""
    return "".join(x for x in unicodedata.normalize("NFKD", c) if x < "\x80")


_LETTERS = [(chr(k), _plain(chr(k))) for k in (*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFB00, 0xFB07), *range(0xFF01, 0xFF5F))]
_ONE = [(c, p) for c, p in _LETTERS if len(p) == 1]
_MORE = [(c, p) for c, p in _LETTERS if len(p) > 1]


def slug(c: Column) -> Column:
    """Column-name form of a label: its runs of ASCII letters and digits, lower-cased, joined by underscores.

    Accented and compatibility letters of the Latin blocks count as their
    plain ones; other characters beyond ASCII are skipped, splitting nothing.
    """
    spelled = c
    for one, many in _MORE:
        spelled = F.replace(spelled, F.lit(one), F.lit(many))
    accented = F.translate(F.when(c.rlike("[" + "".join(x for x, _ in _MORE) + "]"), spelled).otherwise(c), "".join(x for x, _ in _ONE), "".join(x for _, x in _ONE))
    plain = F.lower(F.regexp_replace(F.when(c.rlike(r"[^\x00-\x7F]"), accented).otherwise(c), r"[^\x00-\x7F]", ""))
    return F.array_join(F.regexp_extract_all(plain, F.lit("([a-z0-9]+)"), 1), "_")


def with_slug(df: DataFrame, name: str, out: str) -> DataFrame:
    """Slug each distinct name once and join it back."""
    names = df.select(name).distinct().withColumn(out, slug(F.col(name)))
    return df.join(names, name, "left")
