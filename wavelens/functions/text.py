"""Column expressions for headers and answer texts."""

from __future__ import annotations

import json
import sys
import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Header formats of the raw waves.
DOTTED_HEADER = r"^(\d+(?:\.[A-Za-z0-9]+)*)[_ ]+(.*)$"
TUPLE_HEADER = r"^\(\s*'(.*?)'\s*,\s*'(.*?)'\s*\)$"


# The characters that count as blank, in any script.
BLANKS = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _unicode(pattern: str) -> str:
    """A header pattern for the JVM: digits and blanks of all scripts, lines end at newlines."""
    return "(?dU)" + pattern.replace(r"\s", f"[{BLANKS}]")


def lit_col(name: str) -> Column:
    """The column called exactly ``name``, even with dots or backticks in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip_space(text: Column) -> Column:
    """Without the blanks of any script at either end."""
    return F.regexp_replace(text, rf"\A[{BLANKS}]+|[{BLANKS}]+\z", "")


def repair_mojibake(text: Column) -> Column:
    """Undo UTF-8 read as Latin-1 (``nÃ£o`` -> ``não``); anything else is unchanged.

    Only text made of Latin-1 characters can be such damage, and it is damage
    only if its Latin-1 bytes are valid UTF-8. Plain ASCII, told by its length in bytes,
    never is.
    """
    as_bytes = F.encode(text, "ISO-8859-1").cast("string")
    return F.when(F.octet_length(text) == F.length(text), text).when(
        text.rlike(r"\A[\x00-\xFF]*\z"), F.coalesce(F.try_validate_utf8(as_bytes), text)
    ).otherwise(text)


def parse_question(raw: Column, style: str = "dotted", fixes: Mapping | None = None) -> Column:
    """Split a raw header into ``struct(code, label)``; ``code`` is NULL if there is none.

    ``dotted`` reads ``2.l.1_Label``; ``tuple`` reads ``('P1_a ', 'Label')`` and
    turns ``_`` in the code into ``.``. ``fixes`` maps a malformed raw header to
    its ``(code, label)``.
    """
    if style == "dotted":
        text = strip_space(raw)
        code = F.nullif(F.regexp_extract(text, _unicode(DOTTED_HEADER), 1), F.lit(""))
        label = F.when(code.isNull(), text).otherwise(
            strip_space(F.regexp_extract(text, _unicode(DOTTED_HEADER), 2))
        )
    elif style == "tuple":
        text = strip_space(raw)
        matched = text.rlike(_unicode(TUPLE_HEADER))
        code = F.when(matched, strip_space(F.regexp_extract(text, _unicode(TUPLE_HEADER), 1)))
        label = F.when(matched, strip_space(F.regexp_extract(text, _unicode(TUPLE_HEADER), 2))).otherwise(raw)
        for bad, (fixed_code, fixed_label) in (fixes or {}).items():
            code = F.when(raw == bad, F.lit(fixed_code)).otherwise(code)
            label = F.when(raw == bad, F.lit(fixed_label)).otherwise(label)
        code = F.translate(code, "_", ".")
    else:
        raise ValueError(f"unknown header style: {style}")
    return F.struct(code.alias("code"), label.alias("label"))


def _plain(char: str) -> str:
    decomposed = unicodedata.normalize("NFKD", char)
    return "".join(c for c in decomposed if not unicodedata.combining(c))


def _accent_tables() -> tuple[str, str, dict[str, str]]:
    """Rule: compatibility decomposition without marks, over all of Unicode.

    Letters that stay one letter and bare marks (dropped) make one ``translate``. Those
    that become several are looked up; Hangul syllables among them follow by arithmetic.
    """
    changed = {}
    for code in range(0xA0, sys.maxunicode + 1):
        char = chr(code)
        if not 0xD800 <= code < 0xE000 and (plain := _plain(char)) != char:
            changed[char] = plain
    single = {c: p for c, p in changed.items() if len(p) == 1}
    several = {c: p for c, p in changed.items() if len(p) > 1 and not _is_syllable(c)}
    marks = "".join(c for c, p in changed.items() if not p)
    return "".join(single) + marks, "".join(single.values()), several


def _is_syllable(char: str) -> bool:
    return 0xAC00 <= ord(char) <= 0xD7A3


_ACCENTED, _UNACCENTED, _EXPANDED = _accent_tables()
_SYLLABLE = r"[\x{ac00}-\x{d7a3}]"


def _letter(code: Column) -> Column:
    """The character of a code point of the basic plane."""
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 4, "0")), "UTF-16BE")


def _syllable_letters(char: Column) -> Column:
    """The two or three letters of a Hangul syllable."""
    number = F.ascii(char) - 0xAC00
    last = number % 28
    return F.concat(
        _letter(F.floor(number / 588) + 0x1100),
        _letter(F.floor(number % 588 / 28) + 0x1161),
        F.when(last > 0, _letter(last + 0x11A7)).otherwise(""),
    )


def _expand(text: Column) -> Column:
    """Letters that decompose into several, one by one; only texts that hold any pay for it.

    Whether a text holds any is told by taking them out: one look-up per letter, where a
    pattern would try hundreds of ranges.
    """
    table = F.from_json(F.lit(json.dumps(_EXPANDED)), "map<string,string>")
    letters = F.transform(
        F.split(text, ""),
        lambda c: F.when(F.ascii(c) < 128, c)
        .when(c.rlike(_SYLLABLE), _syllable_letters(c))
        .otherwise(F.coalesce(F.element_at(table, c), c)),
    )
    several = (F.translate(text, "".join(_EXPANDED), "") != text) | text.rlike(_SYLLABLE)
    return F.when(several, F.array_join(letters, "")).otherwise(text)


def strip_accents(text: Column) -> Column:
    """Letters without diacritics and compatibility forms, in every script.

    Plain ASCII text skips the tables.
    """
    plain = F.translate(_expand(text), _ACCENTED, _UNACCENTED)
    return F.when(text.rlike(r"[^\x00-\x7F]"), plain).otherwise(text)


def normalize_name(text: Column) -> Column:
    """A column name without accents, capitals, punctuation ``,?().`` or blanks."""
    text = F.lower(strip_accents(F.replace(text, F.lit("/"), F.lit("_"))))
    text = F.regexp_replace(F.translate(text, ",?().", ""), rf"[{BLANKS}_]+", "_")
    return F.trim(text, F.lit("_"))
