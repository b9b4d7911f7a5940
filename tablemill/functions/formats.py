"""Translation of strftime directives to Spark datetime patterns."""

from __future__ import annotations

import re

# Strftime directive -> (letter of the Spark pattern, digits).
DIRECTIVES = {
    "Y": ("y", 4),
    "m": ("M", 2),
    "d": ("d", 2),
    "H": ("H", 2),
    "M": ("m", 2),
    "S": ("s", 2),
    "f": ("S", 6),
}

# Strftime directive -> regular expression of its values, one digit
# allowed where the field has room.
SHAPES = {
    "Y": "[0-9]{4}",
    "m": "(0?[1-9]|1[0-2])",
    "d": "(0?[1-9]|[12][0-9]|3[01])",
    "H": "([01]?[0-9]|2[0-3])",
    "M": "[0-5]?[0-9]",
    "S": "[0-5]?[0-9]",
    "f": "([0-9]{6})?",
}


def value_shape(fmt: str) -> str:
    """Regular expression of the text a format can read."""
    parts = split_format(fmt)
    shapes = [SHAPES[v] if kind == "field" else re.escape(v) for kind, v in parts]
    return "^" + "".join(shapes) + "$"


# Regular expression of the years of four digits that have no 29th of February.
LEAP = "([0-9]{2}(0[48]|[2468][048]|[13579][26])|([02468][048]|[13579][26])00)"
COMMON_YEAR = f"(?!{LEAP})[0-9]{{4}}"


def impossible_day(fmt: str) -> str | None:
    """Regular expression of text of the right shape whose day its month lacks; none if
    the format has no day and month.

    The parser finds those too, but by throwing an exception, which costs far more.
    """
    parts = split_format(fmt)
    if not {"m", "d"} <= {v for kind, v in parts if kind == "field"}:
        return None
    cases = [{"m": "0?2", "d": "3[01]"}, {"m": "(0?[469]|11)", "d": "31"}]
    if ("field", "Y") in parts:
        cases.append({"Y": COMMON_YEAR, "m": "0?2", "d": "29"})
    shapes = [
        "".join({**SHAPES, **case}[v] if kind == "field" else re.escape(v) for kind, v in parts)
        for case in cases
    ]
    return "^(" + "|".join(shapes) + ")$"


def digit_shape(pattern: str) -> str | None:
    """Regular expression of the text a Spark pattern of numeric fields can read, None for
    other patterns."""
    if re.search(r"[^yMdHmsS0-9:./ -]|(?<!M)MMM", pattern):
        return None

    def digits(run: re.Match) -> str:
        return "[0-9]+" if len(run[0]) == 1 else f"[0-9]{{{len(run[0])}}}"

    return "^" + re.sub(r"([yMdHmsS])\1*", digits, re.sub(r"[./-]", r"[\g<0>]", pattern)) + "$"


def split_format(fmt: str) -> list[tuple[str, str]]:
    """Format as a list of ("field", directive) and ("text", literal)."""
    parts: list[tuple[str, str]] = []
    i = 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            if fmt[i + 1] not in DIRECTIVES:
                raise ValueError(f"directive %{fmt[i + 1]} is not supported")
            parts.append(("field", fmt[i + 1]))
            i += 2
        else:
            parts.append(("text", fmt[i]))
            i += 1
    return parts


def spark_pattern(fmt: str, parsing: bool = False) -> str:
    """Spark pattern of a strftime format.

    When parsing, a field next to text takes one or two digits as strptime does;
    fields that touch each other keep their full width.
    """
    parts = split_format(fmt)
    out = []
    for i, (kind, value) in enumerate(parts):
        if kind == "text":
            out.append("''" if value == "'" else f"'{value}'" if value.isalpha() else value)
            continue
        letter, width = DIRECTIVES[value]
        touches = any(
            0 <= j < len(parts) and parts[j][0] == "field" for j in (i - 1, i + 1)
        )
        if parsing and width == 2 and not touches:
            width = 1
        out.append(letter * width)
    return "".join(out)


def field_positions(fmt: str) -> dict[str, tuple[int, int]]:
    """Start (0-based) and width of every field in text written with the format."""
    at, positions = 0, {}
    for kind, value in split_format(fmt):
        if kind == "text":
            at += 1
        else:
            width = DIRECTIVES[value][1]
            positions.setdefault(value, (at, width))
            at += width
    return positions
