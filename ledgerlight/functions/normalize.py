"""Cleaning raw fields without guessing: what isn't recognised stays as it is and leaves a remark.

A field is a pair of Columns, value and remark (null where there is nothing to say); remarks() joins them in order.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space that a Python-like strip removes: as a set of characters and as a pattern.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
SPACE = f"[{BLANKS}]"
#: Digits that count as numbers beside ASCII's.
INDIC_DIGITS = "०१२३४५६७८९০১২৩৪৫৬৭৮৯"

#: Spellings of relation and gender that have one clear meaning, by source.
RELATIONS = {
    "csv": {"": "", "-": "", "F": "F", "FATHER": "F", "TAMDE": "F", "TAMDA": "F", "TAMDE.": "F", "TEMDE": "F", "S/O": "F", "H": "H", "HUSBAND": "H", "GAMDA": "H", "GAMDE": "H", "M": "M", "MOTHER": "M", "TAYI": "M", "O": "O", "OTHER": "O", "ITARE": "O", "ITERE": "O"},
    "devanagari": {"": "", "पि": "F", "िप": "F", "प": "H", "मा": "M", "अ": "O"},
    "glyph": {"": "", "-": "", "F": "F", "FATHER": "F", "H": "H", "HUSBAND": "H", "M": "M", "MOTHER": "M", "O": "O", "OTHER": "O", "OTHERS": "O"},
}
GENDERS = {
    "csv": {"": "", "-": "", "MALE": "M", "M": "M", "GAN": "M", "FEMALE": "F", "F": "F", "HEM": "F", "HAN": "F"},
    "devanagari": {"": "", "पु": "M", "म": "F"},
    "glyph": {"": "", "-": "", "M": "M", "MALE": "M", "F": "F", "FEMALE": "F"},
}
RELATION_LABELS = {"F": "Father", "H": "Husband", "M": "Mother", "O": "Other/Guardian"}


def strip(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))


def clean(text: Column) -> Column:
    """Trimmed; NULL in any case becomes empty."""
    value = strip(text)
    return F.when(F.upper(value) == "NULL", "").otherwise(value)


def collapse(text: Column) -> Column:
    """Every run of white space is one space; trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", " "))


def quoted(text: Column) -> Column:
    """The text as a quoted literal: single quotes, or double ones where it has single and no double ones."""
    body = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    only = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    return F.when(only, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _literal_map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])


def lookup(text: Column, table: dict[str, str], label: str, fold: bool = True, strip_dots: bool = False) -> tuple[Column, Column]:
    """(code, remark): table's code, or the trimmed raw value with a remark. fold: keys are compared in upper case."""
    value = strip(text) if fold else collapse(text)
    if strip_dots:
        value = F.regexp_replace(value, r"\.+$", "")
    code = F.try_element_at(_literal_map(table), F.upper(value) if fold else value)
    remark = F.when(code.isNull() & (value != ""), F.concat(F.lit(f"unrecognized {label}: "), quoted(value)))
    return F.coalesce(code, value), remark


def integer(text: Column, label: str) -> tuple[Column, Column]:
    """(int, remark): blank and NULL are null without a remark; anything that is no integer is null with one."""
    value = clean(text)
    ascii_ = F.translate(value, INDIC_DIGITS, "01234567890123456789")
    number = F.when(ascii_.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$"), F.replace(ascii_, F.lit("_")).try_cast("int"))
    remark = F.when((value != "") & number.isNull(), F.concat(F.lit(f"non-numeric {label}: "), quoted(value)))
    return number, remark


def loose_integer(text: Column, label: str) -> tuple[Column, Column]:
    """(int, remark): all digits, else the digits found, with a remark; undecoded glyphs make it null."""
    value = strip(text)
    ascii_ = F.translate(value, INDIC_DIGITS, "01234567890123456789")
    digits = F.regexp_replace(ascii_, "[^0-9]", "")
    number = F.when((digits != "") & ~undecoded(value), digits.try_cast("int"))
    remark = F.when((value == "") | ascii_.rlike("^[0-9]+$"), None).when(undecoded(value), F.concat(F.lit(f"unreadable {label}: "), masked(value))).otherwise(F.concat(F.lit(f"non-numeric {label}: "), quoted(value)))
    return number, remark


def joined(*parts: Column) -> Column:
    """Non-empty parts with a space between."""
    return F.concat_ws(" ", *[F.nullif(p, F.lit("")) for p in parts])


def filled(text: Column, size: int) -> Column:
    """Zero-filled on the left to at least size characters; longer values stay."""
    return F.when(F.length(text) < size, F.lpad(text, size, "0")).otherwise(text)


def area_code(raw: Column, expected: Column) -> Column:
    """Remark where a row's own area code, brought to the usual form, isn't that of its file."""
    up = F.upper(raw)
    usual = F.when((up != "") & ~up.startswith("A"), F.concat(F.lit("A"), filled(up, 3))).otherwise(up)
    return F.when(usual != expected, F.concat(F.lit("source row listed ac_code "), quoted(raw), F.lit("; using "), expected, F.lit(" (from filename)")))


def part_number(raw: Column) -> tuple[Column, Column]:
    """(int, remark) of a part id: its leading digits; a suffix leaves a remark."""
    bare = F.regexp_replace(raw, "^0+(?=.)", "")
    digits = F.regexp_extract(bare, "^([0-9]+)", 1)
    remark = F.when((digits != "") & (digits != bare), F.concat(F.lit("source part id is "), quoted(bare), F.lit(", recorded as part "), digits))
    return F.nullif(digits, F.lit("")).try_cast("int"), remark


def authority(known: Column, raw: Column) -> Column:
    """The reference value, or the row's own where there is none."""
    return F.coalesce(F.nullif(known, F.lit("")), raw, F.lit(""))


def remarks(*found: Column) -> Column:
    return F.concat_ws("; ", *found)


def relation_label(code: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(RELATION_LABELS), code), code)


# glyphs that a page's font doesn't name: private-use characters from U+E000 on, offset by glyph number


def undecoded(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"[\x{E000}-\x{EFFF}]")


def masked(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x{E000}-\x{EFFF}]", "?")


def glyph_key(text: Column) -> Column:
    """Hexadecimal numbers of the undecoded glyphs, joined by hyphens."""
    found = F.filter(F.split(text, ""), lambda c: c.rlike(r"^[\x{E000}-\x{EFFF}]$"))
    return F.array_join(F.transform(found, lambda c: F.lpad(F.hex(F.ascii(c) - 0xE000), 2, "0")), "-")


def glyph_lookup(text: Column, table: dict[str, str], label: str) -> tuple[Column, Column]:
    """(code, remark) of a cell with undecoded glyphs; a cell without passes through."""
    code = F.try_element_at(_literal_map(table or {"": ""}), glyph_key(text))
    miss = undecoded(text) & code.isNull()
    return F.when(~undecoded(text), text).otherwise(F.coalesce(code, F.lit(""))), F.when(miss, F.concat(F.lit(f"unrecognized {label} in Bengali script: gid "), glyph_key(text)))


def glyph_numbers(names: Column) -> Column:
    """Numbers in glyph names like G1F; null if a name isn't of that kind."""
    numbers = F.transform(names, lambda n: F.conv(F.nullif(F.regexp_extract(n, "^G([0-9A-Fa-f]{2,4})$", 1), F.lit("")), 16, 10).cast("int"))
    return F.when(~F.exists(numbers, lambda n: n.isNull()), numbers)


def font_characters(numbers: Column) -> Column:
    """Characters of a font's glyphs: Latin in the standard order if all numbers lie in 3 to 97, else private-use ones."""
    latin = F.forall(numbers, lambda n: n.between(3, 97))
    return F.transform(numbers, lambda n: F.when(latin, F.char(n + 29)).otherwise(F.decode(F.unhex(F.lpad(F.hex(n + 0xE000), 4, "0")), "UTF-16BE")))
