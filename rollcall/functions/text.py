"""Text clean-up, name building, and path rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space when text is stripped.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"

# Characters a file or folder name must not keep. The first string
# is replaced one by one by the second; characters beyond its end are removed.
NAME_FROM, NAME_TO = '\n\r\t<>/\\|:"?*%', "   __+__"
PATH_FROM, PATH_TO = '\n\r\t<>|:"?*%', "   ___"

# What Spark escapes in the folder of a partition value, the percent sign
# first, and how it calls the folder of a value that is empty.
ESCAPED_IN_FOLDERS = "%\"#'*/:=?\\{[]^\x7f" + "".join(map(chr, range(1, 32)))
NO_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# First characters that make a spreadsheet read text as a formula.
FORMULA_SIGNS = ("=", "+", "-", "@")


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _stripped(c: Column | str) -> tuple[Column, Column, Column]:
    """Whether the text ends visibly once spaces are off, that text, and the text without any blanks.

    Trimming a set of characters walks the whole text. Spaces alone are trimmed by their
    bytes, and text that then starts and ends with a visible ASCII character, as most
    does, is told by its first and last byte.
    """
    text = F.trim(as_column(c))
    last = F.substring(text.cast("binary"), -1, 1)
    visible = (text >= "!") & (text < "\x80") & (last >= b"!") & (last < b"\x80")
    return visible, text, F.btrim(text, F.lit(BLANKS))


def strip(c: Column | str) -> Column:
    """Remove white space of any script from both ends."""
    visible, text, walked = _stripped(c)
    return F.when(visible, text).otherwise(walked)


def blank_to_null(c: Column | str) -> Column:
    """Strip, then turn an empty text into null."""
    visible, text, walked = _stripped(c)
    return F.when(visible, text).otherwise(F.nullif(walked, F.lit("")))


def or_blank(c: Column | str) -> Column:
    """Null becomes the empty text."""
    return F.coalesce(as_column(c), F.lit(""))


def collapse_blanks(c: Column | str) -> Column:
    """Each run of white space becomes one space."""
    return F.regexp_replace(as_column(c), BLANK_RUN, " ")


def optional_part(c: Column | str) -> Column:
    """`` (x)`` for a non-blank ``x``, else nothing."""
    text = strip(or_blank(c))
    return F.when(text != "", F.concat(F.lit(" ("), text, F.lit(")"))).otherwise("")


def address(
    street: Column | str,
    zipcode: Column | str,
    city: Column | str,
    country: Column | str,
    district: Column | str | None = None,
    tidy: bool = False,
) -> Column:
    """``street, zip city (district), country``; missing parts leave their commas.

    ``tidy`` also collapses the white space that missing parts leave behind.
    """
    part = lambda c: strip(or_blank(c))
    pieces = [part(street), F.lit(", "), part(zipcode), F.lit(" "), part(city)]
    if district is not None:
        pieces.append(optional_part(district))
    text = F.concat(*pieces, F.lit(", "), part(country))
    return strip(collapse_blanks(text)) if tidy else text


def payee(name: Column | str, company: Column | str) -> Column:
    """``name (company)``, or the one that is given, or the empty text."""
    person, firm = strip(or_blank(name)), strip(or_blank(company))
    return F.when(person == "", firm).otherwise(F.concat(person, optional_part(firm)))


def join_flags(flags: Mapping[str, Column | str], yes: str = "Ja") -> Column:
    """Names of the flags that equal ``yes``, joined by a comma."""
    return F.concat_ws(
        ", ", *[F.when(as_column(c) == yes, F.lit(name)) for name, c in flags.items()]
    )


def same_text(left: Column | str, right: Column | str) -> Column:
    """Equality that ignores case and outer white space."""
    return normalised(left) == normalised(right)


def normalised(c: Column | str) -> Column:
    return F.lower(strip(or_blank(c)))


def shown_length(c: Column | str) -> Column:
    """Length of a value as text; null counts as nothing."""
    return F.length(or_blank(as_column(c).cast("string"))).cast("bigint")


def escape_formula(c: Column | str) -> Column:
    """Put a quote before text that a spreadsheet would run as a formula.

    Text whose first byte is an ASCII one and neither a blank nor a sign is told without a trim.
    """
    text = as_column(c)
    plain = ((text >= ".") & (text < "=")) | ((text >= "A") & (text < "\x80"))
    first = F.substring(F.ltrim(text, F.lit(BLANKS)), 1, 1)
    return F.when(plain, text).when(first.isin(*FORMULA_SIGNS), F.concat(F.lit("'"), text)).otherwise(text)


def file_name(c: Column | str) -> Column:
    """A text as a file name."""
    return strip(F.translate(as_column(c), NAME_FROM, NAME_TO))


def stored_value(c: Column | str) -> Column:
    """A partition value as Spark writes it into the path of its folder."""
    text = as_column(c)
    for sign in ESCAPED_IN_FOLDERS:
        text = F.replace(text, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(NO_FOLDER))


def folder_path(c: Column | str) -> Column:
    """A text as a folder path: no forbidden characters, no empty steps.

    Dots and spaces before a separator go, then spaces after one, then repeats
    of the same separator. A trailing dot takes the run of dots and blanks with it.
    """
    text = strip(F.translate(as_column(c), PATH_FROM, PATH_TO))
    text = F.regexp_replace(text, r"(?U)\.[.\s\x1c-\x1f]*\z", "")
    text = strip(text)
    text = F.regexp_replace(text, r"[ .]+(?=[/\\])", "")
    text = F.regexp_replace(text, r"(?<=[/\\]) +", "")
    return F.regexp_replace(text, r"([/\\])\1+", "$1")


def ancestors(c: Column | str) -> Column:
    """All folders on the way to a path, outermost first, the path itself last."""
    steps = F.split(F.rtrim(as_column(c), F.lit("/\\")), "/")
    paths = F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"),
    )
    return F.filter(paths, lambda p: (p != "") & ~p.endswith("/"))


def parent_folder(c: Column | str) -> Column:
    return F.regexp_extract(as_column(c), r"(?s)^(.*?)/*[^/]*$", 1)


def base_name(c: Column | str) -> Column:
    return F.substring_index(as_column(c), "/", -1)


def with_suffix(c: Column | str, suffix: str, ignore_case: bool = False) -> Column:
    """Append ``suffix`` unless the text ends with it already."""
    text = as_column(c)
    probe = F.lower(text) if ignore_case else text
    return F.when(probe.endswith(suffix), text).otherwise(F.concat(text, F.lit(suffix)))


def climbs_out(c: Column | str) -> Column:
    """True where a path holds a step to its parent folder."""
    text = as_column(c)
    return F.coalesce(text.contains("../") | text.contains("/.."), F.lit(False))


def label_or_default(name: Column | str, prefix: str, key: Column | str) -> Column:
    """A looked-up name, or a label built from the key that was not found."""
    return F.coalesce(
        as_column(name),
        F.concat(F.lit(prefix), F.coalesce(as_column(key).cast("string"), F.lit("None"))),
    )


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of conditions in which unknown counts as false."""
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result
