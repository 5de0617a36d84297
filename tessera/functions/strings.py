"""String expressions for file names and manifests: P9-P13, F1.

Everything here is a column expression (no Python per row).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.constants import (ALLOWED_IMAGE_FORMATS, CLASS_INDEX_DIGITS, DEFAULT_IMAGE_SUFFIX,
                               MANIFEST_SUFFIX_LENGTH)
from tessera.functions.labels import base_name, strip_trailing_slashes

__all__ = ["ALLOWED_IMAGE_FORMATS", "DEFAULT_IMAGE_SUFFIX"]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_left_keep(s, width: int, fill: str = "0") -> Column:
    """Left-pad to ``width``; longer strings are kept whole (never cut)."""
    s = _col(s).cast("string")
    return F.lpad(s, F.greatest(F.length(s), F.lit(width)), fill)


def pad_right_keep(s, width: int, fill: str = " ") -> Column:
    """P10: right-pad to ``width``; longer strings are kept whole."""
    s = _col(s).cast("string")
    return F.rpad(s, F.greatest(F.length(s), F.lit(width)), fill)


def file_extension(name) -> Column:
    """Text after the last dot of a name, when that dot is not its first
    character; NULL otherwise."""
    name = _col(name)
    # position of the last dot, 1-based (0 = none)
    last_dot = F.length(name) - F.locate(".", F.reverse(name)) + 1
    has_ext = (F.locate(".", F.reverse(name)) > 0) & (last_dot > 1)
    return F.when(has_ext, F.substring_index(name, ".", -1))


def has_extension(name, formats) -> Column:
    """case-sensitive suffix whitelist on the text after the last dot."""
    return F.coalesce(F.array_contains(F.array(*[F.lit(f) for f in formats]), file_extension(name)),
                      F.lit(False))


def suffix_match(path, suffixes) -> Column:
    """Case-sensitive plain suffix match (no dot added: ``bin``
    also matches ``xbin``)."""
    p = _col(path)
    cond = F.lit(False)
    for s in suffixes:
        cond = cond | p.endswith(s)
    return cond


def url_local_name(url) -> Column:
    """Local file name for a URL.

    The last path part of the URL; if it has no accepted image extension
    (or no dot after its first character), a suffix is appended. The suffix
    taken from the URL always carries its leading dot, so it never matches
    the dot-less whitelist and becomes ``.jpg``; a URL without any dot has no
    suffix at all, which makes the whole name NULL (bad line).
    """
    u = _col(url)
    local = base_name(u)
    ok = has_extension(local, ALLOWED_IMAGE_FORMATS)
    url_has_dot = F.locate(".", u) > 0
    return (F.when(ok, local)
            .when(url_has_dot, F.concat(local, F.lit(DEFAULT_IMAGE_SUFFIX))))


def class_dir_name(index, file_name, width: int = CLASS_INDEX_DIGITS) -> Column:
    """``<zero-padded index>.<file name minus its last 4 chars>``."""
    fn = _col(file_name)
    stem = F.substring(fn, F.lit(1), F.greatest(F.length(fn) - MANIFEST_SUFFIX_LENGTH, F.lit(0)))
    return F.concat(pad_left_keep(index, width), F.lit("."), stem)


def target_path(root: str, class_dir, local_name) -> Column:
    """Root / class directory / local name (NULL if any part is NULL)."""
    return F.concat(F.lit(root.rstrip("/")), F.lit("/"), _col(class_dir), F.lit("/"), _col(local_name))


def url_host(url) -> Column:
    return F.regexp_extract(_col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)


def url_path_normalised(url) -> Column:
    return strip_trailing_slashes(url)
