"""Text expressions: missing and URL predicates, sanitising, trimming, folding."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

REPLACEMENT_CHAR = "�"
WEB_URL = r"^https?://"


def named(column: str) -> Column:
    """A column by its name, whatever characters the name has."""
    return F.col("`" + column.replace("`", "``") + "`")


def free_name(columns: list[str], base: str) -> str:
    """``base``, or with as many underscores behind it as make it a name that none of the columns has."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base += "_"
    return base


def rendered(df: DataFrame, column: str) -> Column:
    """A column as text, a number that is NaN as NULL."""
    c = named(column)
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c.cast("string"))
    return c.cast("string")


def is_missing(c: Column) -> Column:
    """NULL or the empty string, whatever the column's type."""
    return c.isNull() | (c.cast("string") == F.lit(""))


def is_present(c: Column) -> Column:
    return c.isNotNull() & (c.cast("string") != F.lit(""))


def is_numeric_missing(c: Column, words: tuple[str, ...]) -> Column:
    return c.isNull() | c.isin(*words)


def is_web_url(c: Column) -> Column:
    return c.rlike(WEB_URL)


def sanitise(c: Column) -> Column:
    """Valid UTF-8 without control, format, private-use or unassigned characters."""
    return F.regexp_replace(F.make_valid_utf8(c), r"\p{C}", "")


def trim_all(c: Column) -> Column:
    """Trim every Unicode white-space character; Spark's ``trim`` only knows U+0020."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def trim_ascii(c: Column) -> Column:
    """Trim blanks, tabs and line ends only."""
    return F.regexp_replace(c, r"^[ \t\r\n]+|[ \t\r\n]+$", "")


def squish(c: Column) -> Column:
    """Trim, and turn every inner run of white space into one blank."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL when nothing matches."""
    return blank_to_null(F.regexp_extract(c, pattern, group))


def all_matches(c: Column, pattern: str, group: int = 1) -> Column:
    """Every match of a group, in order, as an array."""
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


def joined_matches(c: Column, pattern: str, separator: str = ", ") -> Column:
    """Every match of group 1 as one string; ``''`` when nothing matches."""
    return F.array_join(all_matches(c, pattern, 1), separator)


def needs_care(c: Column) -> Column:
    """True where a text has anything but printable ASCII with single inner blanks.

    One cheap look that spares plain texts, usually the bulk, the checks below.
    """
    return c.rlike(r"[^ -~]|^ |  | $")


def has_edge_space(c: Column) -> Column:
    return c.rlike(r"(?U)^\s|\s$")


def has_space_run(c: Column) -> Column:
    return c.rlike(r"(?U)\s{2,}")


def has_line_break(c: Column) -> Column:
    return c.rlike(r"[\n\r]")


def bounded_key(c: Column, limit: int = 64) -> Column:
    """A stand-in for a text value that never exceeds ``limit + 2`` characters.

    Distinct counts shuffle their keys, and keys may be whole web pages. Values
    up to ``limit`` stand for themselves; longer ones by a SHA-256 digest whose
    66 characters no short value can have. NULL stays NULL.
    """
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.lit("h:"), F.sha2(c, 256)))


def _one_zero(c: Column, kind: T.DataType) -> Column:
    """The value with -0.0 as 0.0, also inside arrays, structs and maps; map entries in key order."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return c + F.lit(0.0).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _one_zero(x, kind.elementType))
    if isinstance(kind, T.StructType):
        parts = [_one_zero(c.getField(f.name), f.dataType).alias(f.name) for f in kind]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(kind, T.MapType):
        return F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
            _one_zero(e["key"], kind.keyType).alias("key"), _one_zero(e["value"], kind.valueType).alias("value"))))
    return c


def row_digest(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 over a reversible rendering of a whole row.

    Each field is written as its length and its text, and NULL as a mark of its
    own; arrays, structs and maps are written as JSON, whose quotes and brackets
    keep their parts apart. -0.0 is 0.0 and NaN is NaN, as in a grouping. Rows
    have equal digests exactly when all their fields are equal. A wide row then
    costs 32 bytes in a shuffle.
    """
    def field(name: str) -> Column:
        kind = df.schema[name].dataType
        value = _one_zero(named(name), kind)
        if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
            text = F.when(named(name).isNotNull(), F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}))
        elif isinstance(kind, T.BinaryType):
            text = F.hex(value)
        else:
            text = value.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


# Latin letters and punctuation without a canonical decomposition.
_FOLD_SPECIAL = {
    "Æ": "AE", "Ð": "D", "Ø": "O", "Þ": "TH", "ß": "ss", "æ": "ae", "ð": "d", "ø": "o", "þ": "th",
    "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "ı": "i", "ĸ": "q", "Ł": "L", "ł": "l",
    "Ŋ": "N", "ŋ": "n", "Œ": "OE", "œ": "oe", "Ŧ": "T", "ŧ": "t", "ẞ": "SS",
    "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "―": "-",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "‟": '"',
    "‹": "<", "›": ">", "«": "<<", "»": ">>", "…": "...", "©": "(C)", "®": "(R)", "×": "*", "÷": "/",
    " ": " ",
}

# Blocks whose letters are folded by rule: Latin-1, Extended-A and -B, Additional, ligatures, full width.
_FOLD_BLOCKS = ((0x00C0, 0x0250), (0x1E00, 0x1F00), (0xFB00, 0xFB07), (0xFF01, 0xFF5F))


def _fold_table() -> tuple[dict[str, str], dict[str, str]]:
    """(one-to-one, one-to-many) letter maps, derived from Unicode decompositions."""
    table = dict(_FOLD_SPECIAL)
    for start, stop in _FOLD_BLOCKS:
        for ch in map(chr, range(start, stop)):
            base = "".join(x for x in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(x))
            base = "".join(_FOLD_SPECIAL.get(x, x) for x in base)
            if ch not in table and base and base.isascii():
                table[ch] = base
    single = {k: v for k, v in table.items() if len(v) == 1}
    return single, {k: v for k, v in table.items() if len(v) != 1}


_ONE_TO_ONE, _ONE_TO_MANY = _fold_table()
_FOLD_FROM, _FOLD_TO = "".join(_ONE_TO_ONE), "".join(_ONE_TO_ONE.values())
_NOT_ASCII = r"[^\x00-\x7F]"


def fold_latin(c: Column) -> Column:
    """Latin letters and punctuation to ASCII; other scripts are left alone.

    Only texts that hold a non-ASCII character pay for the replacements.
    """
    bare = F.regexp_replace(c, r"(?<=[\p{IsLatin}0-9]\p{Mn}{0,8})\p{Mn}", "")
    single = F.translate(bare, _FOLD_FROM, _FOLD_TO)
    many = reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), _ONE_TO_MANY.items(), single)
    return F.when(c.rlike(_NOT_ASCII), many).otherwise(c)
