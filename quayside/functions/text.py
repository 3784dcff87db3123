"""Text clean-up: identifiers, port codes, coordinates written as text, HTML fragments."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE_BLANKS = r"^[\s\x{A0}]+|[\s\x{A0}]+$"
_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def strip(text: Column) -> Column:
    """Remove blanks of any kind, no-break ones too, from both ends."""
    return F.regexp_replace(text, _EDGE_BLANKS, "")


def strip_imo_prefix(imo: Column) -> Column:
    """Drop one leading ``IMO``, capitals only."""
    return F.regexp_replace(imo, "^IMO", "")


def to_number(text: Column) -> Column:
    """Text to double; null unless it is a plain decimal number."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def bare_code(raw: Column) -> Column:
    """A port code as written, blanks out and in upper case."""
    return F.upper(F.translate(raw, "\u00a0 ", ""))


def locode(country: Column, code: Column) -> Column:
    """Full port code: a 3-character code gets the country in front."""
    return F.when(F.length(code) == 3, F.concat(country, code)).otherwise(code)


def is_country_code(code: Column) -> Column:
    """Two characters, at least one of them a letter with case, none in lower case."""
    return (F.length(code) == 2) & (F.upper(code) == code) & (F.lower(code) != code)


def unece_coord(text: Column) -> Column:
    """Degrees from ``DDMMX`` / ``DDDMMX``: the sign is minus for S and W, plus for any other letter."""
    size = F.length(text)
    minutes = to_number(F.substring(text, size - 2, F.lit(2)))
    degrees = to_number(F.substring(text, F.lit(1), size - 3))
    sign = F.when(F.substring(text, size, F.lit(1)).isin("S", "W"), -1.0).otherwise(1.0)
    return F.when(size >= 5, (degrees + minutes / 60.0) * sign)


def coordinate_pair(text: Column) -> tuple[Column, Column]:
    """``"5157N 00408E"`` to (lat, lon). Without a blank there is no longitude."""
    parts = F.split(text, " ")
    return unece_coord(F.get(parts, F.lit(0))), unece_coord(F.get(parts, F.lit(1)))


def route_key(dep: Column, arr: Column) -> Column:
    """Name of a port pair; an unknown end is written ``UNK``."""
    unknown = F.lit("UNK")
    return F.concat_ws("_", F.lit("route"), F.coalesce(dep, unknown), F.coalesce(arr, unknown))


def _character(code_point: Column) -> Column:
    """One character from its number; null if there is none."""
    known = (code_point > 0) & (code_point < 0x110000) & ~code_point.between(0xD800, 0xDFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(code_point), 8, "0")), "UTF-32"))


def unescape_html(text: Column) -> Column:
    """Resolve ``&name;`` (all HTML 5 names), ``&#n;`` and ``&#xn;``; anything else stays as it is.

    As in old pages, the semicolon may be missing after numbers, and after names that HTML 5 lists without one; of these the longest that fits counts.
    """
    # One constant, folded once, instead of thousands of literals in the plan.
    coded = sorted((name, value.encode("utf-16-be").hex()) for name, value in html5.items())
    names = F.str_to_map(F.lit(",".join(f"{name}:{code}" for name, code in coded)))
    open_names = "|".join(sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name)))

    def resolve(piece: Column) -> Column:
        closed = F.regexp_extract(piece, r"^([A-Za-z][A-Za-z0-9]*;)", 1)
        digits = F.regexp_extract(piece, r"^(#[0-9]{1,7}(?![0-9])|#[xX][0-9a-fA-F]{1,6}(?![0-9a-fA-F]));?", 1)
        number = F.when(digits.rlike("^#[xX]"), F.conv(F.substring(digits, F.lit(3), F.length(digits)), 16, 10).try_cast("int")).otherwise(
            F.substring(digits, F.lit(2), F.length(digits)).try_cast("int")
        )
        known = F.try_element_at(names, closed).isNotNull()
        name = F.when(known, closed).otherwise(F.regexp_extract(piece, f"^({open_names})", 1))
        named = F.decode(F.unhex(F.try_element_at(names, name)), "UTF-16BE")
        after_number = F.regexp_replace(F.substring(piece, F.length(digits) + 1, F.length(piece)), "^;", "")
        after_name = F.substring(piece, F.length(name) + 1, F.length(piece))
        return F.coalesce(F.concat(_character(number), after_number), F.concat(named, after_name), F.concat(F.lit("&"), piece))

    pieces = F.split(text, "&")
    resolved = F.concat(
        F.get(pieces, F.lit(0)),
        F.concat_ws("", F.transform(F.slice(pieces, 2, F.size(pieces)), resolve)),
    )
    return F.when(F.instr(text, "&") > 0, resolved).otherwise(text)


def html_text(fragment: Column) -> Column:
    """Visible text of a fragment: every run of text is stripped, then all are joined."""
    runs = F.split(F.regexp_replace(fragment, r"(?s)<!--.*?-->", ""), r"(?s)<[^>]*>")
    return F.concat_ws("", F.transform(runs, lambda run: strip(unescape_html(run))))
