"""Markup and written text brought into a plain form: references to characters, links, brackets, dates with
hyphens, and what announces a celebration instead of a name."""

from __future__ import annotations

import re
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from lychgate.functions import written
from lychgate.functions.names import unaccent

#: Words by which the text of a link asks for something.
ASKING = ("click", "here", "read more", "subscribe", "donate", "log in", "share", "order")


def entities(c: Column, blank: bool = True) -> Column:
    """References to characters, named, decimal and hexadecimal, as the characters, in one pass: what a reference gives
    is not read again. Unknown ones stay. blank: a no-break space becomes a blank."""
    names = F.create_map(*[F.lit(v) for pair in name2codepoint.items() for v in pair] + [F.lit("apos"), F.lit(39)])

    def told(piece: Column) -> Column:
        name = F.regexp_extract(piece, r"^&(#?[A-Za-z0-9]+);", 1)
        known = F.try_element_at(names, name)
        digits = F.when(name.rlike(r"^#[0-9]{1,7}$"), F.substring(name, 2, 7).cast("int")).when(
            name.rlike(r"^#[xX][0-9A-Fa-f]{1,6}$"), F.conv(F.substring(name, 3, 6), 16, 10).cast("int")
        )
        code = F.coalesce(known, digits)
        code = F.when(code == 160, 32).otherwise(code) if blank else code
        fine = ((code > 0) & (code < 0xD800)) | ((code > 0xDFFF) & (code <= 0x10FFFF))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when(fine, F.concat(char, F.regexp_replace(piece, r"^&#?[A-Za-z0-9]+;", ""))).otherwise(piece)

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(F.split(c, "(?=&)", -1), told), "")).otherwise(c)


def without_links(c: Column, calls_only: bool = False, asking: tuple[str, ...] = ASKING) -> Column:
    """Markup without its links and their text; calls_only: only those whose text holds one of the words `asking`."""
    text = r"(?:(?!</a>).)*?"
    inner = rf"{text}\b(?:{'|'.join(map(re.escape, asking))})\b{text}" if calls_only else text
    return F.regexp_replace(c, rf"(?is)<a\b[^>]*>{inner}</a>", "")


def without_bracketed(c: Column, left: str = "(", right: str = ")") -> Column:
    """Text without what stands between two marks, blanks squeezed."""
    l, r = "\\Q" + left + "\\E", "\\Q" + right + "\\E"
    return F.trim(F.regexp_replace(F.regexp_replace(c, rf"(?s){l}(?:(?!{r}).)*{r}", " "), r"\s+", " "))


def without_all(c: Column, chars: str) -> Column:
    """Text without any of some characters."""
    return F.translate(c, chars, "")


def even_brackets(c: Column) -> Column:
    """Text without round brackets that have no partner."""
    return written.even_brackets(c)


def without_inner_points(c: Column) -> Column:
    """Text without points inside it, but those after St and Ste; a first and a last one stay."""
    return F.regexp_replace(c, r"(?i)(?<=.)(?<!(?<![^ \-])ste?)\.(?=.)", "")


def plain_dates(c: Column) -> Column:
    """Dates whose fields hyphens part as 2020/1/31, Jan. 5, 2020 or January 5, 2020; a hyphen between two of them stands between blanks."""
    return written.plain_dates(c)


def pure_date_range(c: Column, language: str | None = None) -> Column:
    """Whether a text is two written dates with a hyphen and nothing else; by language (en, fr), or in any of them."""
    return written.pure_date_range(c, language)


def range_language(c: Column) -> Column:
    """en or fr where pure_date_range() holds by it, else null."""
    return written.range_language(c)


def without_celebration(c: Column) -> Column:
    """A heading without celebration (of life) and the passing of."""
    c = F.regexp_replace(c, r"(?i)-? ?celebration( of life)? ?(-|for|of)?", "")
    return F.regexp_replace(c, "(?i)(the )?passing of ", "")


def all_digits(c: Column) -> Column:
    """All digits of a text as one number, 0 without any."""
    return F.coalesce(F.regexp_replace(c, "[^0-9]", "").try_cast("long"), F.lit(0).cast("long"))


def begins_with_vowel(c: Column) -> Column:
    return unaccent(c).rlike("(?i)^[aeiouy]")


def is_foreign(c: Column) -> Column:
    """Whether a letter with an accent, or a ligature, is in a text."""
    return c != unaccent(c)


def quoted(c: Column) -> Column:
    """Whether a text stands in quotation marks."""
    return c.rlike("(?s)^[\"'“‘«].*[\"'”’»]$")


def before_last(c: Column, mark: str) -> Column:
    """What stands before the last mark, null without one."""
    return F.when(F.contains(c, F.lit(mark)), F.regexp_extract(c, "(?s)^(.*)\\Q" + mark + "\\E", 1))


def after_last(c: Column, mark: str) -> Column:
    """What stands after the last mark, null without one."""
    return F.when(F.contains(c, F.lit(mark)), F.substring_index(c, mark, -1))


def between_if(c: Column, left: str, right: str, stop: str) -> Column:
    """What stands between two marks, null where `stop` comes before the second one or a mark is missing."""
    l, r, s = ("\\Q" + m + "\\E" for m in (left, right, stop))
    return F.nullif(F.regexp_extract(c, rf"(?s)^(?:(?!{l}).)*{l}((?:(?!{r}|{s}).)*){r}", 1), F.lit(""))
