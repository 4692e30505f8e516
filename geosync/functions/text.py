"""Text column functions: blanks, labels, names, paths, column names."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Names a feature table keeps for itself, names that carry geometry, longest column name.
RESERVED_COLUMNS = ("id", "geom", "loaded_at", "task_key")
GEOMETRY_COLUMNS = (
    "geometry", "geom", "geodata", "geodata_center", "coordinates", "wkt", "geo_data", "geocenter",
)
MAX_COLUMN_LENGTH = 63

# Where a key's words end: other characters than ASCII's letters and digits, or a change of case. A class, as Java tests
# a negated list of ranges ten times slower; one pattern, as every key of every row passes through.
_WORD_ENDS = r"\P{Alnum}+|(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])"

# Picture suffixes and the longest stored file name.
PHOTO_SUFFIXES = (".jpg", ".jpeg", ".png")
MAX_FILE_NAME = 200


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_all(value: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def blank_to_null(value: Column) -> Column:
    """Without surrounding spaces; NULL when nothing is left."""
    return F.nullif(F.trim(value), F.lit(""))


def strip_to_null(value: Column) -> Column:
    """Like :func:`blank_to_null`, for every kind of white space."""
    return F.nullif(strip_all(value), F.lit(""))


def effective_id(*candidates: Column) -> Column:
    """First candidate that is not blank."""
    return F.coalesce(*[blank_to_null(c) for c in candidates])


def to_column_name(key: Column) -> Column:
    """Snake-case column name for a JSON key, NULL when the key cannot name a column."""
    # White space at the ends turns into underscores and goes with them.
    name = F.lower(F.trim(F.regexp_replace(key, _WORD_ENDS, "_"), F.lit("_")))

    def checked(made: Column) -> Column:
        full = F.when(made < ":", F.concat(F.lit("field_"), made)).otherwise(made)
        return F.when((made != "") & ~made.isin(*RESERVED_COLUMNS), F.substring(full, 1, MAX_COLUMN_LENGTH))

    # Only letters, digits and underscores are left, so a name below ":" starts with a digit.
    return let(name, checked)


def normalize_attr(value: Column) -> Column:
    """One line, single spaces, no spaces around hyphens; NULL when empty."""
    line = F.regexp_replace(value, r"[\r\n]+", " ")
    line = F.regexp_replace(line, r"\s+", " ")
    return blank_to_null(F.regexp_replace(line, r"\s*-\s*", "-"))


def normalize_label(value: Column) -> Column:
    """:func:`normalize_attr` with spaces and hyphens turned into single underscores."""
    joined = F.regexp_replace(F.regexp_replace(normalize_attr(value), "[ -]+", "_"), "_+", "_")
    return F.regexp_replace(joined, "^_+|_+$", "")


def split_number(value: Column) -> Column:
    """``prefix-12`` as ``struct(prefix, n)``; ``n`` is NULL without a numeric tail."""
    tail = F.regexp_extract(value, "-([0-9]+)$", 1)
    return F.struct(
        F.regexp_replace(value, "-[0-9]+$", "").alias("prefix"),
        tail.try_cast("int").alias("n"),
    )


def _base_name(path: Column) -> Column:
    """Last component of a POSIX path, ignoring trailing slashes and ``.`` components."""
    return F.regexp_extract(F.regexp_replace(path, r"(/\.?)+$", ""), "([^/]*)$", 1)


def sanitize_file_name(name: Column) -> Column:
    """``struct(name, error)``: a safe picture file name, or why there is none."""
    base = strip_all(_base_name(name))
    safe = F.regexp_replace(base, "[^A-Za-z0-9._-]+", "_")
    safe = F.regexp_replace(safe, r"^[._]+|[._]+$", "")
    suffix = F.regexp_extract(safe, r"(?<=.)(\.[^.]*)$", 1)
    stem = F.substring(safe, F.lit(1), F.length(safe) - F.length(suffix))
    short = F.when(
        F.length(safe) > MAX_FILE_NAME,
        F.concat(F.substring(stem, F.lit(1), F.lit(MAX_FILE_NAME) - F.length(suffix)), suffix),
    ).otherwise(safe)
    error = (
        F.when(base.isNull() | base.isin("", ".", ".."), F.lit("filename is required"))
        .when(safe == "", F.lit("invalid filename"))
        .when(~F.lower(suffix).isin(*PHOTO_SUFFIXES), F.lit("allowed extensions: .jpg, .jpeg, .png"))
    )
    return F.struct(F.when(error.isNull(), short).alias("name"), error.alias("error"))


def legacy_name(name: Column) -> Column:
    """Old download name: base name with forbidden characters replaced, else NULL."""
    base = F.regexp_replace(_base_name(strip_all(name)), r'[<>:"/\\|?*\x00-\x1f]', "_")
    return F.when(~base.isin("", ".", ".."), base)


def ext_from_mime(mime: Column) -> Column:
    """Picture suffix for a content type; ``.jpg`` unless it says PNG."""
    kind = F.lower(strip_all(F.split_part(mime, F.lit(";"), F.lit(1))))
    return F.when(kind == "image/png", F.lit(".png")).otherwise(F.lit(".jpg"))


def _clean_parts(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda part: part != "")


def _has_dots(parts: Column) -> Column:
    return F.exists(parts, lambda part: part.isin(".", ".."))


def normalize_path(path: Column) -> Column:
    """``struct(relpath, error)``: a relative POSIX path below a share, or the reason it is refused."""
    posix = F.replace(strip_all(path), F.lit("\\"), F.lit("/"))
    parts = _clean_parts(posix)
    error = (
        F.when(F.coalesce(posix, F.lit("")) == "", F.lit("empty path"))
        .when(posix.startswith("/") | (F.substring(posix, 2, 1) == ":"), F.lit("absolute path"))
        .when(F.size(parts) == 0, F.lit("empty path"))
        .when(_has_dots(parts), F.lit("path traversal"))
    )
    return F.struct(
        F.when(error.isNull(), F.array_join(parts, "/")).alias("relpath"), error.alias("error")
    )


def path_after_marker(path: Column, marker: str) -> Column:
    """``struct(relpath, error)``: what follows the first ``marker`` folder, found ignoring case."""
    posix = F.replace(strip_all(path), F.lit("\\"), F.lit("/"))
    at = F.instr(F.lower(posix), marker.lower())
    after = F.substring(posix, at + F.lit(len(marker)), F.length(posix))
    parts = _clean_parts(after)
    error = (
        F.when(F.coalesce(posix, F.lit("")) == "", F.lit("empty path"))
        .when(at == 0, F.lit("no marker"))
        .when(F.size(parts) == 0, F.lit("ends at marker"))
        .when(_has_dots(parts), F.lit("path traversal"))
    )
    return F.struct(
        F.when(error.isNull(), F.array_join(parts, "/")).alias("relpath"), error.alias("error")
    )


def is_photo(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1)).isin(*PHOTO_SUFFIXES)


def match_any(value: Column, words: tuple[str, ...]) -> Column:
    """True when ``value`` contains one of ``words``, ignoring case."""
    lowered = F.lower(value)
    hit = F.lit(False)
    for word in words:
        hit = hit | lowered.contains(word.lower())
    return hit


def not_prefix_or_null(value: Column, prefix: str) -> Column:
    return value.isNull() | ~value.startswith(prefix)


def scoped_id(kind: Column | str, row_id: Column) -> Column:
    """``point:17`` and the like: the business id of one layer row."""
    head = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat(head, F.lit(":"), row_id.cast("string"))


def is_scoped(value: Column) -> Column:
    return value.rlike("^(point|line|polygon):")


def is_true(value: Column) -> Column:
    return F.coalesce(value, F.lit(False))


def is_not_true(value: Column) -> Column:
    return ~F.coalesce(value, F.lit(False))


def is_distinct(left: Column, right: Column) -> Column:
    return ~left.eqNullSafe(right)


def audit_stamp(login: str, at: Column) -> Column:
    """``[login, ISO time]``, the audit pair kept on work items."""
    return F.array(F.lit(login), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"))


def item_key(business_id: Column) -> Column:
    """UUID-shaped key that depends on the business id alone, so that a retried run repeats it."""
    digest = F.md5(business_id.cast("binary"))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )


#: Texts of an Arrow batch that are Python strings at once.
NFC_ROWS = 256


@F.arrow_udf(StringType())
def _compose(names: pa.Array) -> pa.Array:
    def composed(some: pa.Array) -> pa.Array:
        made = some.to_pylist()
        return pa.array([None if v is None else unicodedata.normalize("NFC", v) for v in made], some.type)

    if not len(names):
        return names
    return pa.concat_arrays([composed(names.slice(low, NFC_ROWS)) for low in range(0, len(names), NFC_ROWS)])


def nfc(value: Column) -> Column:
    """Unicode NFC form, of which few texts at once become Python strings."""
    return _compose(value)
