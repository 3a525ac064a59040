"""Strings: trimming, classes, numbers, ids, URLs, markup, sentences, words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Abbreviations whose full stop does not end a sentence.
ABBREVIATIONS = ("Mr", "Mrs", "Ms", "Dr", "St", "Rev", "Jr", "Sr", "Mme", "Mlle", "M", "Ave", "No")
#: Short months, whose full stop does not end a sentence before a number, and what goes on after a.m. and p.m. with a capital.
SHORT_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Sept", "Oct", "Nov", "Dec")
DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
#: Named entities.
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " "}


def once(value: Column, use) -> Column:
    """use(value) with value computed once a row, however often use mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def drop_left(c: Column, n: int) -> Column:
    return F.substr(c, F.lit(n + 1))


def drop_right(c: Column, n: int) -> Column:
    return F.left(c, F.greatest(F.lit(0), F.length(c) - n))


def middle(c: Column, start: int, n: int) -> Column:
    """n characters from the start-th, counted from 1."""
    return F.substring(c, start, n)


def strip_ends(c: Column, chars: str = r"\s,;:\-") -> Column:
    return F.regexp_replace(c, f"^[{chars}]+|[{chars}]+$", "")


def strip_possessive(c: Column) -> Column:
    return F.regexp_replace(c, "(?i)['’]s$|(?<=s)['’]$", "")


def strip_book_ends(c: Column, left: str, right: str) -> Column:
    """Without a pair of marks around the whole."""
    inside = F.startswith(c, F.lit(left)) & F.endswith(c, F.lit(right)) & (F.length(c) >= len(left) + len(right))
    return F.when(inside, F.substr(c, F.lit(len(left) + 1), F.length(c) - len(left) - len(right))).otherwise(c)


def proper(c: Column) -> Column:
    """Name case: capitals after blanks, hyphens, slashes and apostrophes, and after Mc."""
    lowered = F.lower(c)
    parts = F.regexp_extract_all(lowered, F.lit(r"([^ \-/']*[ \-/']?)"), F.lit(1))
    up = lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
    mac = lambda w: F.when(w.rlike("^mc[a-z]{2,}"), F.concat(F.lit("Mc"), up(F.substr(w, F.lit(3))))).otherwise(up(w))
    return F.array_join(F.transform(parts, mac), "")


def pre_hyphen(c: Column) -> Column:
    return F.substring_index(c, "-", 1)


def post_hyphen(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("-")), F.regexp_replace(c, "^[^-]*-", "")).otherwise(F.lit(""))


def reciprocal(c: Column) -> Column:
    """The two sides of a hyphen exchanged."""
    return F.when(F.contains(c, F.lit("-")), F.concat_ws("-", post_hyphen(c), pre_hyphen(c))).otherwise(c)


def is_numeric(c: Column) -> Column:
    return c.rlike("^[0-9]+$")


def is_alpha(c: Column) -> Column:
    return c.rlike(r"^\p{L}+$")


def is_all_caps(c: Column) -> Column:
    return c.rlike(r"\p{Lu}") & ~c.rlike(r"\p{Ll}")


def is_capitalised(c: Column) -> Column:
    return c.rlike(r"^\p{Lu}")


def as_number(c: Column) -> Column:
    """A number written with currency, separators, sign or per cent; 0 where there is none."""
    plain = F.regexp_replace(c, r"[$€£,\s]", "")
    percent = F.endswith(plain, F.lit("%"))
    number = F.rtrim(plain, F.lit("%")).try_cast("double")
    return F.coalesce(F.when(percent, number / 100).otherwise(number), F.lit(0.0))


def first_number(c: Column) -> Column:
    """The first run of digits as a number, null if there is none."""
    return F.regexp_extract(c, "([0-9]+)", 1).try_cast("long")


def to_id(c: Column) -> Column:
    """Blanks, commas and slashes as characters that ids may hold."""
    return F.translate(c, " ,/", "_$#")


def from_id(c: Column) -> Column:
    return F.translate(c, "_$#", " ,/")


def url_parameter(c: Column, name: str) -> Column:
    """The last value of a parameter in a URL's query, null if absent."""
    found = F.regexp_extract_all(c, F.lit(rf"[?&]{name}=([^&#]*)"), F.lit(1))
    return F.try_element_at(found, F.lit(-1))


def url_safe(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit(" "), F.lit("%20")), r"[^A-Za-z0-9._~:/?#\[\]@!$&'()*+,;=%-]", "")


def unescape(c: Column) -> Column:
    """Named entities and decimal references of printable ASCII as characters."""
    for entity, char in ENTITIES.items():
        if entity != "&amp;":
            c = F.replace(c, F.lit(entity), F.lit(char))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def strip_tags(c: Column) -> Column:
    """Text of markup: scripts, styles, comments and tags as blanks, blanks squeezed."""
    c = F.regexp_replace(c, r"(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"<[^>]*>", " "), r"\s+", " "))


def within(c: Column, tag: str) -> Column:
    """Text inside the first element of a tag, null if there is none."""
    return F.nullif(F.regexp_extract(c, rf"(?s)<{tag}[^>]*>(.*?)</{tag}>", 1), F.lit(""))


def meta_content(c: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(c, rf'<meta[^>]*name="{name}"[^>]*content="([^"]*)"', 1), F.lit(""))


def json_value(c: Column, key: str) -> Column:
    """A quoted or bare value of a key in text that need not be whole JSON."""
    return F.nullif(F.regexp_extract(c, rf'"{key}"\s*:\s*"?([^",}}\]]*)', 1), F.lit(""))


def sentences(c: Column) -> Column:
    """Sentences; full stops after initials and common abbreviations do not end one, nor those of short months before a number, nor
    those of a.m. and p.m. before anything but a capital or before a weekday."""
    guard, months, days = ("|".join(x) for x in (ABBREVIATIONS, SHORT_MONTHS, DAYS))
    dated = rf"(?!(?<=(?:^|[^\p{{L}}])(?:{months})\.)\s+[0-9])"
    timed = rf"(?!(?<=(?:^|[^\p{{L}}])[AaPp]\.[Mm]\.)\s+(?:[^\p{{Lu}}\s]|(?:{days})))"
    parts = F.split(c, rf"(?<=[.!?])(?<!(?:^|[^\p{{L}}])(?:{guard}|\p{{Lu}})\.){dated}{timed}\s+")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def words(c: Column) -> Column:
    """Lower-case words of letters."""
    return F.filter(F.split(F.lower(c), r"[^\p{L}]+"), lambda w: F.length(w) > 0)


def count_words(c: Column) -> Column:
    return F.size(F.filter(F.split(F.trim(c), r"\s+"), lambda w: F.length(w) > 0))


def first_difference(a: Column, b: Column) -> Column:
    """The first place, from 1, where two strings differ; 0 if they are equal."""
    n = F.greatest(F.length(a), F.length(b))
    places = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    first = F.element_at(F.filter(places, lambda i: F.substr(a, i, F.lit(1)) != F.substr(b, i, F.lit(1))), 1)
    return F.when(a == b, F.lit(0)).otherwise(first)


def sorted_list(a: Column, fold: bool = False, descending: bool = False, unique: bool = False) -> Column:
    """A list sorted by text, case folded if asked."""
    key = F.lower if fold else (lambda x: x)
    out = F.array_sort(a, lambda x, y: F.when(key(x) < key(y), -1).when(key(x) > key(y), 1).when(x < y, -1).when(x > y, 1).otherwise(0))
    out = F.array_distinct(out) if unique else out
    return F.reverse(out) if descending else out


def between(c: Column, left: str, right: str) -> Column:
    """Text after the first `left` up to the next `right`, null if either is missing. Both are plain text."""
    rest = after(c, left)
    return F.when(F.locate(right, rest) > 0, F.substring_index(rest, right, 1))


def after(c: Column, mark: str) -> Column:
    """Text after the first mark, null if there is none."""
    at = F.locate(mark, c)
    return F.when(at > 0, F.substr(c, at + len(mark)))


def before(c: Column, mark: str) -> Column:
    """Text before the first mark, the whole if there is none."""
    return F.substring_index(c, mark, 1)


def first_of(c: Column, *marks: str) -> Column:
    """The mark that comes first, null if none does."""
    places = F.array_sort(F.array_compact(F.array(*[F.when(F.locate(m, c) > 0, F.struct(F.locate(m, c).alias("at"), F.lit(m).alias("mark"))) for m in marks])))
    return F.try_element_at(places, F.lit(1))["mark"]


def nth_position(c: Column, mark: str, n: int) -> Column:
    """Place, from 1, of the n-th mark, 0 if there are fewer."""
    head = F.substring_index(c, mark, n)
    return F.when(F.size(F.split(c, "\\Q" + mark + "\\E", -1)) > n, F.length(head) + 1).otherwise(0)


def straight_quotes(c: Column) -> Column:
    """Curly and angle quotation marks as plain ones."""
    return F.translate(F.translate(c, "“”„«»", '"' * 5), "‘’‚", "'" * 3)


def clean(c: Column) -> Column:
    """Text ready for sentences: plain quotes, one blank for several, none before marks, one after, brackets
    without blanks inside, points inside abbreviations of letters left out."""
    c = F.regexp_replace(straight_quotes(c), r"\s+", " ")
    c = F.regexp_replace(c, r"\b((?:\p{Lu}\.){2,})", "$1\u0001")
    c = F.regexp_replace(c, r"(?<=\p{Lu})\.(?=\p{Lu}\.|\u0001)", "")
    c = F.replace(c, F.lit("\u0001"), F.lit(""))
    c = F.regexp_replace(c, r" +([,;:!?.])", "$1")
    c = F.regexp_replace(c, r"([,;])(?=\p{L})", "$1 ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\( +", "("), r" +\)", ")"))


def occurrences(c: Column, word: str) -> Column:
    """How often a whole word stands in a text, case aside."""
    return F.regexp_count(c, F.lit(rf"(?i)(?<![\p{{L}}]){word}(?![\p{{L}}])"))


def by_length(a: Column) -> Column:
    """A list from short to long, equal lengths by text."""
    return F.array_sort(a, lambda x, y: F.when(F.length(x) != F.length(y), F.length(x) - F.length(y)).when(x < y, -1).when(x > y, 1).otherwise(0))
