"""Image links, file names and folders."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weighlens.functions.times import time_text
from weighlens.schemas import IMAGE_EXTENSIONS, URL_EXTENSIONS


def _extension_pattern(extensions: tuple[str, ...]) -> str:
    return "(?i)(" + "|".join("\\" + e for e in extensions) + ")$"


def has_extension(path: Column, extensions: tuple[str, ...] = IMAGE_EXTENSIONS) -> Column:
    return F.coalesce(path.rlike(_extension_pattern(extensions)), F.lit(False))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)


def parent_folder(path: Column) -> Column:
    """Folder part without the last component; '' at the top."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def folder_depth(folder: Column) -> Column:
    """Number of components of a folder with its trailing slash."""
    return F.size(F.split(folder, "/")) - 1


def folder_at(path: Column, depth: Column) -> Column:
    """First ``depth`` components with the trailing slash: 'a/b/c.jpg' at 2 is 'a/b/'."""
    return F.concat(F.call_function("substring_index", path, F.lit("/"), depth), F.lit("/"))


def clean_image_link(link: Column) -> Column:
    """Storage key without quotes and leading slashes; NULL for '', 'none' and 'null'."""
    text = F.regexp_replace(F.regexp_replace(F.trim(link), '^"+|"+$', ""), "^'+|'+$", "")
    usable = text.isNotNull() & ~F.lower(text).isin("", "none", "null")
    return F.when(usable, F.regexp_replace(F.trim(text), "^/+", ""))


def dataset_filename(start_time: Column, transaction_id: Column, key: Column) -> Column:
    """``<yyyyMMddHHmmss>_<transaction>_<original name>`` with a known image extension."""
    stamp = F.coalesce(F.regexp_replace(time_text(start_time), "[^0-9]", ""), F.lit("0" * 14))
    name = F.coalesce(base_name(key), F.lit(""))
    extension = F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    stem = F.when(extension != "", F.regexp_replace(name, r"\.[^.]+$", "")).otherwise(name)
    stem = F.when(stem == "", F.lit("image")).otherwise(stem)
    known = F.lower(extension).isin(*IMAGE_EXTENSIONS)
    original = F.when(known, name).otherwise(F.concat(stem, F.lit(".jpg")))
    return F.concat_ws("_", stamp, F.coalesce(transaction_id.cast("string"), F.lit("unknown")), original)


def filename_transaction_id(filename: Column) -> Column:
    """Second '_' part of a dataset file name, '' when there is none."""
    return F.coalesce(F.get(F.split(filename, "_", 3), F.lit(1)), F.lit(""))


def relative_folder(local_path: Column, dataset_folder: Column) -> Column:
    """Folder of a file below its dataset folder: '.' at the top, '' outside it."""
    parts = F.filter(F.split(local_path, "/"), lambda p: p != "")
    at = F.array_position(parts, dataset_folder)
    depth = F.size(parts) - at.cast("int")
    inner = F.array_join(F.slice(parts, at.cast("int") + 1, F.greatest(depth - 1, F.lit(0))), "/")
    return (
        F.when(F.coalesce(at, F.lit(0)) == 0, F.lit(""))
        .when(depth > 1, inner)
        .otherwise(F.lit("."))
    )


def path_component(text: Column) -> Column:
    """Folder-safe text; NULL when nothing is left."""
    clean = F.regexp_replace(F.trim(text.cast("string")), "[^a-zA-Z0-9_.-]", "_")
    return F.when(clean != "", clean)


def target_folder(transaction_id: Column, parts: list[Column]) -> Column:
    """Folder built from any number of columns; the transaction id when there are none."""
    if not parts:
        return transaction_id.cast("string")
    return F.concat_ws("/", *[path_component(p) for p in parts])


def safe_name(text: Column) -> Column:
    """Letters, digits, spaces, '-' and '_' only, without trailing spaces."""
    return F.rtrim(F.regexp_replace(text, r"[^\p{L}\p{N} _-]", ""))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def image_extension(url: Column, allowed: tuple[str, ...] | None = URL_EXTENSIONS) -> Column:
    """Extension of the URL's path, '.jpg' when it is missing or not in the allowed list."""
    found = F.regexp_extract(url_path(url), r"[^/.][^/]*?(\.[^./]*)$", 1)
    good = (found != "") if allowed is None else F.lower(found).isin(*allowed)
    return F.when(F.coalesce(good, F.lit(False)), found).otherwise(F.lit(".jpg"))


def storage_bucket(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def storage_key(uri: Column) -> Column:
    return F.regexp_replace(url_path(uri), "^/+", "")
