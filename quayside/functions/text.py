"""Expressions over log lines, paths and JSON text."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Escape sequences of terminals: control sequences, titles, two-character escapes.
_ANSI = r"\x1B(?:\[[0-?]*[ -/]*[@-~]|\][^\x07\x1B]*(?:\x07|\x1B\\)|[ -/]*[0-Z\\^-~])"
_ESCAPE = "\x1b"
# Characters with the Unicode property White_Space (fixed values).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Line layout (fixed values): level, ISO time with a fraction, message. The separator
# before the fraction may be any character here; only a dot passes the time check.
_TIME = (
    r"[0-9]{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[1-2][0-9]|3[0-1])"
    r"T(?:2[0-3]|[01][0-9]):[0-5][0-9]:[0-5][0-9].[0-9]+"
)
# Possessive quantifiers and the look-behind keep the search linear in long words. When
# times are glued together, the last one counts.
_PARTS = rf"(\w++)[ ]++(?:{_TIME})*({_TIME})[ ]++(.*)"
_LINE = rf"(?dU)(?<!\w){_PARTS}"
_EVENT = rf"(?dU)^{_PARTS}"


def clean_line(message: Column) -> Column:
    """Remove terminal escapes, then white space at both ends."""
    bare = F.when(
        message.contains(_ESCAPE), F.regexp_replace(message, _ANSI, "")
    ).otherwise(message)
    return F.btrim(bare, F.lit(WHITE_SPACE))


def parse_utc(text: Column) -> Column:
    """Time of a log line as a timestamp, null when it is no valid time."""
    dotted = F.substring(text, 20, 1) == "."
    return F.when(dotted, F.concat(text, F.lit("Z")).try_cast("timestamp"))


def find_event(cleaned: Column) -> Column:
    """Stretch of a cleaned line from the level to its end; empty when there is none."""
    return F.regexp_extract(cleaned, _LINE, 0)


def first_word(text: Column) -> Column:
    return F.substring_index(text, " ", 1)


def after_first_word(text: Column) -> Column:
    return F.ltrim(F.substring(text, F.length(first_word(text)) + 1, F.length(text)))


def event_time(event: Column, after_level: Column) -> Column:
    """Text of the time of a found event.

    It is the word after the level, unless that word is too long or has no fraction, as with
    several times glued together.
    """
    word = first_word(after_level)
    plain = (F.substring(word, 20, 1) == ".") & (F.length(word) <= 29)
    return F.when(plain, word).otherwise(F.regexp_extract(event, _EVENT, 2))


def event_message(event: Column, after_level: Column, time: Column) -> Column:
    """Message of a found event."""
    plain = first_word(after_level) == time
    return F.when(plain, after_first_word(after_level)).otherwise(
        F.regexp_extract(event, _EVENT, 3)
    )


def without_scheme(uri: Column) -> Column:
    """Path of a file URI: no scheme and no authority."""
    return F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "")


def bare_path(uri: Column) -> Column:
    """Path of an encoded URI, such as file metadata give, with percent escapes decoded."""
    path = without_scheme(uri)
    return F.when(
        path.contains("%"),
        F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path),
    ).otherwise(path)


def path_part(path: Column, log_root: str, group: int, with_pod: bool = False) -> Column:
    """Group of ``<log_root>/[<pod>/]<container>/<file>``; null when the path differs."""
    pod = "([^/]*)/" if with_pod else ""
    pattern = f"^{re.escape(log_root.rstrip('/'))}/{pod}(.*?)/(.*?)$"
    return F.nullif(F.regexp_extract(path, pattern, group), F.lit(""))


def json_text(document: Column, *keys: str) -> Column:
    """Text below a chain of object keys; keys may hold ``:`` and ``@``."""
    if any("'" in key for key in keys):
        raise ValueError("a key must not contain a single quote")
    return F.get_json_object(document, "$" + "".join(f"['{key}']" for key in keys))
