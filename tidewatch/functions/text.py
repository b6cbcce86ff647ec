"""Text rules as Column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters up to the space, without line feed and carriage return.
BLANKS = r"[\x00-\x09\x0B\x0C\x0E-\x20]"
# Characters up to the space; white space of script languages.
EDGES = r"^[\x00-\x20]+|[\x00-\x20]+$"
SCRIPT_SPACE = r"[\t\n\x0B\f\r \xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\uFEFF]+"

#: Characters beyond ASCII with a name in HTML 4, from the standard's table.
NAMED_CHARACTERS = {chr(code): name for name, code in sorted(name2codepoint.items()) if code > 127}

# Line ends and single quotes, percent-encoded and plain.
ENCODED_NEWLINE_OR_QUOTE = r"%(?:0[AaDd]|27)"
NEWLINE_OR_QUOTE = ("\r", "\n", "'")

# Length from which a name is cut, length kept.
NAME_LIMIT = 36
NAME_KEPT = 32


def trim_all(text: Column) -> Column:
    """Trim every character up to the space, control characters included, at both ends."""
    return F.regexp_replace(text, EDGES, "")


def trim_keep_crlf(text: Column) -> Column:
    """Trim characters up to the space at both ends but stop at line ends."""
    return F.regexp_replace(F.regexp_replace(text, f"^{BLANKS}+", ""), f"{BLANKS}+$", "")


def host_of(host_port: Column) -> Column:
    """Part before the last ``:``, trimmed; without a colon the text itself, untrimmed."""
    return (F.when(F.contains(host_port, F.lit(":")),
                   trim_all(F.regexp_replace(host_port, r":[^:]*$", "")))
            .otherwise(host_port))


def port_of(host_port: Column) -> Column:
    """Number after the last ``:``; 0 without a colon, null if it is not a number."""
    last = trim_all(F.element_at(F.split(host_port, ":", -1), -1))
    return (F.when(F.contains(host_port, F.lit(":")), last.try_cast("int"))
            .otherwise(F.when(host_port.isNotNull(), F.lit(0))))


def split_list(text: Column) -> Column:
    """Comma separated text to an array of trimmed, non-empty items."""
    items = F.transform(F.split(text, ","), trim_all)
    return F.filter(items, lambda item: F.length(item) > 0)


def join_list(items: Column) -> Column:
    return F.array_join(items, ",")


def simple_class_name(name: Column) -> Column:
    """Class name without packages, trailing ``$`` and interpreter wrappers (``$iw``)."""
    bare = F.element_at(F.split(name, r"\."), -1)
    stripped = F.regexp_replace(bare, r"\$+$", "")
    return (F.when(stripped == "", bare)
            .when(F.contains(stripped, F.lit("$iw")) & F.contains(stripped, F.lit("$")),
                  F.element_at(F.split(stripped, r"\$"), -1))
            .otherwise(stripped))


def formatted_class_name(name: Column) -> Column:
    """``simple_class_name`` without any ``$``."""
    return F.regexp_replace(simple_class_name(name), r"\$", "")


def short_name(name: Column) -> Column:
    """Names of 36 characters or more are cut to 32 and get ``...``."""
    return (F.when(F.length(name) < NAME_LIMIT, name)
            .otherwise(F.concat(F.substring(name, 1, NAME_KEPT), F.lit("..."))))


def strip_xss(text: Column) -> Column:
    """Remove line ends and single quotes, then escape ``& < > "`` and the characters that HTML 4
    names. Only characters beyond ASCII that a text has are looked up, and those with a name replaced."""
    clean = F.when(F.contains(text, F.lit("%")),
                   F.regexp_replace(text, ENCODED_NEWLINE_OR_QUOTE, "")).otherwise(text)
    for plain in NEWLINE_OR_QUOTE:
        clean = F.replace(clean, F.lit(plain), F.lit(""))
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        clean = F.replace(clean, F.lit(plain), F.lit(entity))
    names = F.create_map(*[F.lit(x) for pair in NAMED_CHARACTERS.items() for x in pair])
    found = F.filter(F.array_distinct(F.regexp_extract_all(clean, F.lit(r"[^\x00-\x7F]"), F.lit(0))),
                     lambda c: F.map_contains_key(names, c))
    return F.aggregate(found, clean, lambda out, c: F.replace(
        out, c, F.concat(F.lit("&"), F.element_at(names, c), F.lit(";"))))


def url_decode_fixpoint(text: Column) -> Column:
    """Decode until unchanged; struct of ``value`` and ``settled``, whether decoding once more changes nothing.

    Text that cannot be decoded is kept. Escapes of escapes lie in one run of percent signs and
    hexadecimal digits, and a decoding that changes such a run makes it shorter by two at least, so half the
    longest run bounds the steps; a text's ordinary escapes take two or three.
    """
    runs = F.regexp_extract_all(text, F.lit("%[%0-9A-Fa-f]*"), F.lit(0))
    longest = F.coalesce(F.array_max(F.transform(runs, F.length)), F.lit(0))
    steps = F.when(F.contains(text, F.lit("%")) | F.contains(text, F.lit("+")),
                   F.sequence(F.lit(0), F.floor(longest / 2).cast("int") + 2))

    def decoded(value: Column) -> Column:
        return F.coalesce(F.try_url_decode(value), value)

    start = F.struct(text.alias("value"), F.lit(False).alias("settled"))

    def decode(state: Column, _step: Column) -> Column:
        value = decoded(state["value"])
        return F.when(state["settled"], state).otherwise(
            F.struct(value.alias("value"), (value == state["value"]).alias("settled")))

    value = F.coalesce(F.aggregate(steps, start, decode, lambda state: state["value"]), text)
    return F.struct(value.alias("value"), F.coalesce(decoded(value) == value, F.lit(True)).alias("settled"))


def url_param(url: Column, name: str) -> Column:
    """One query parameter, decoded; empty text if it is missing."""
    raw = F.regexp_extract(url, rf"[?&]{name}=([^&#]*)", 1)
    return F.coalesce(F.try_url_decode(raw), raw)


def strip_tags(html: Column) -> Column:
    """Line ends become spaces, then everything from ``<`` to the next ``>`` is removed."""
    return F.regexp_replace(F.regexp_replace(html, r"[\r\n]", " "), r"<.*?>", "")


def same_filesystem(left: Column, right: Column) -> Column:
    """Whether two URIs name the same file system: scheme, authority, host and port."""
    def part(uri: Column, what: str) -> Column:
        return F.try_parse_url(uri, F.lit(what))

    def port(uri: Column) -> Column:
        return F.regexp_extract(F.coalesce(part(uri, "AUTHORITY"), F.lit("")), r":(\d+)$", 1)

    scheme = part(left, "PROTOCOL")
    authority = part(left, "AUTHORITY")
    other = part(right, "AUTHORITY")
    return F.coalesce(
        scheme.isNotNull() & (scheme == part(right, "PROTOCOL"))
        & (authority.isNull() | F.lower(authority).eqNullSafe(F.lower(other)))
        & part(left, "HOST").eqNullSafe(part(right, "HOST"))
        & (port(left) == port(right)), F.lit(False))
