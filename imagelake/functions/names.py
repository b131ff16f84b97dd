"""String column functions: file names, extensions, display names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_SEP = r"[/\\]"  # both separators (the reference splits on backslash only)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_path(c) -> Column:
    """One spelling per local file: ``file:///x`` (image source) and ``file:/x``
    (file listings) both become ``file:/x``; other schemes are unchanged."""
    return F.regexp_replace(_c(c), r"^file:/+", "file:/")


def basename(c) -> Column:
    """Last path segment."""
    return F.element_at(F.split(_c(c), PATH_SEP), -1)


def parent_name(c) -> Column:
    """Second-last path segment: the label folder of a picture (A1)."""
    parts = F.split(_c(c), PATH_SEP)
    return F.when(F.size(parts) >= 2, F.try_element_at(parts, F.lit(-2)))


def parent_dir(c) -> Column:
    """Path without its last segment (H1)."""
    return F.regexp_extract(_c(c), r"^(.*)[/\\][^/\\]*$", 1)


def file_ext(c) -> Column:
    """Lower-case extension without the dot; empty when there is none."""
    return F.lower(F.regexp_extract(_c(c), r"\.([^./\\]+)$", 1))


def capitalize(c) -> Column:
    """First letter upper, rest lower: ``'bell pepper' -> 'Bell pepper'`` (F2)."""
    c = _c(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def title(c) -> Column:
    """Every word capitalised: ``'bell pepper' -> 'Bell Pepper'`` (F2)."""
    return F.initcap(_c(c))
