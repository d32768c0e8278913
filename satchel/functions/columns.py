"""Scalar helpers shared by the operators, all native expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = "BKMGT"
TRIMMED = "".join(map(chr, range(0x21)))
_SIZE = r"(?i)^\s*([0-9]+(?:\.[0-9]+)?)\s*([KMGT]?B)\s*$"


def parse_data_size(value: Column) -> Column:
    """``'80 MB'`` as bytes, ``-1`` for no limit, NULL when the text is not a size.  One unit step is 1024."""
    number = F.nullif(F.regexp_extract(value, _SIZE, 1), F.lit("")).cast("double")
    unit = F.upper(F.substring(F.regexp_extract(value, _SIZE, 2), 1, 1))
    scaled = F.floor(number * F.pow(F.lit(1024.0), F.instr(F.lit(UNITS), unit) - 1)).cast("long")
    return F.when(F.trim(value) == "-1", F.lit(-1).cast("long")).otherwise(scaled)


def size_option(value: str | int) -> int:
    """A size given as an operator option; a text that is no size is refused."""
    if isinstance(value, int):
        if value < -1:
            raise ValueError(f"not a data size: {value}")
        return value
    if value.strip() == "-1":
        return -1
    match = re.match(_SIZE, value)
    if match is None:
        raise ValueError(f"not a data size: {value!r}")
    return int(float(match.group(1)) * 1024 ** UNITS.index(match.group(2)[0].upper()))


def java_trim(text: Column) -> Column:
    """Strip every character up to and including the blank at both ends."""
    return F.trim(text, F.lit(TRIMMED))


def is_blank(text: Column) -> Column:
    """NULL, empty or nothing but white space; a non-breaking space is a character like any other."""
    return text.isNull() | text.rlike(r"^[[\s\x1C-\x1F\p{Z}]&&[^\u00A0\u2007\u202F]]*$")


def permission_string(mode: Column) -> Column:
    """``rwxr-xr-x`` from the nine permission bits of a file mode."""
    bits = [
        F.when(mode.bitwiseAND(F.lit(1 << i)) != 0, "xwr"[i % 3]).otherwise("-")
        for i in range(8, -1, -1)
    ]
    return F.when(mode.isNotNull(), F.concat(*bits))


def time_string(epoch_seconds: Column) -> Column:
    """``2024-01-31T23:59:00+0000``, in UTC whatever zone the session is in."""
    moment = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=epoch_seconds)
    return F.concat(F.replace(moment.cast("string"), F.lit(" "), F.lit("T")), F.lit("+0000"))


def _normal_path(name: Column) -> Column:
    single = F.regexp_replace(name, "/+", "/")
    return F.when(single == "/", single).otherwise(F.regexp_replace(single, "/$", ""))


def entry_filename(name: Column) -> Column:
    return F.substring_index(_normal_path(name), "/", -1)


def entry_parent(name: Column) -> Column:
    """The directory part of an entry name, ``/`` for a file right below the root, NULL without any directory."""
    normal = _normal_path(name)
    parent = F.regexp_extract(normal, r"(?s)^(.*)/[^/]*$", 1)
    return F.when(normal.contains("/"), F.when(parent == "", "/").otherwise(parent))


def segment_path(name: Column) -> Column:
    parent = entry_parent(name)
    return F.when(parent.isNull(), "/").otherwise(F.concat(parent, F.lit("/")))


def absolute_path(archive_filename: Column, name: Column) -> Column:
    return F.concat(archive_filename, F.lit("/"), F.coalesce(entry_parent(name), F.lit("")))
