"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes, the plain blank first; all of them lie
# below U+3001.
WHITESPACE = " " + "".join(chr(i) for i in range(0x3001) if chr(i).isspace() and i != 32)

# Characters taken out of log texts.
LOG_JUNK = "';§"

LOG_LIMIT = 1_000_000
LOG_NOTICE = "[log entry is truncated and shows only part of the session log]"


def strip(c: Column) -> Column:
    """Remove white space of every kind on both sides."""
    return F.btrim(c, F.lit(WHITESPACE))


def starts_plain(c: Column) -> Column:
    """The first character is a visible one of ASCII: two comparisons of bytes."""
    text = c.cast("string")
    return (text >= "!") & (text < "\x7f")


def rstrip(c: Column) -> Column:
    """Nearly all values end in a visible character and need no trimming."""
    return F.when(starts_plain(F.right(c, F.lit(1))), c.cast("string")).otherwise(F.rtrim(c, F.lit(WHITESPACE)))


def is_blank(c: Column) -> Column:
    """Null, empty or nothing but white space; never null itself.

    The first character settles nearly all values without a copy of long text.
    """
    return F.when(starts_plain(c), F.lit(False)).otherwise(F.coalesce(strip(c) == "", F.lit(True)))


def blank_to_null(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def cut(c: Column, length: int | None) -> Column:
    """Shorten to the column length, when one is known."""
    return c if length is None else F.substring(c, 1, length)


def string_scrub(c: Column, chars: str = '";') -> Column:
    """Drop the given characters (program arguments lose quotes and semicolons)."""
    return F.translate(c, chars, "")


def log_text(c: Column, limit: int | None = None, notice: str = LOG_NOTICE) -> Column:
    """Session log as it is stored: scrubbed, and cut at ``limit`` with a notice.

    There is no cut unless one is asked for; ``LOG_LIMIT`` is that of a column of a
    database that needs it.
    """
    scrubbed = string_scrub(c, LOG_JUNK)
    if limit is None:
        return scrubbed
    return F.when(
        F.length(scrubbed) > limit, F.concat(F.substring(scrubbed, 1, limit), F.lit(notice))
    ).otherwise(scrubbed)


def duration_hms(seconds: Column) -> Column:
    """Seconds as HH:MM:SS; hours may exceed 24."""
    s = seconds.cast("bigint")
    hours = F.call_function("div", s, F.lit(3600))
    minutes = F.call_function("div", s, F.lit(60)) % 60

    def two(c: Column) -> Column:
        text = c.cast("string")
        return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)

    return F.concat(two(hours), F.lit(":"), two(minutes), F.lit(":"), two(s % 60))


def decode_len_prefixed(c: Column) -> tuple[Column, Column]:
    """Split ``LLtext...``: two digits give the length of the first part."""
    n = F.substring(c, 1, 2).try_cast("int")
    return F.substring(c, F.lit(3), n), F.rtrim(F.substring(c, n + 3, F.length(c)))


def base64_text(c: Column) -> Column:
    """Base64 on a single line."""
    return F.translate(F.base64(c), "\r\n", "")


def hex_to_base64(c: Column) -> Column:
    return base64_text(F.unhex(c))
