"""Keys, file names and storage paths."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F


def _quote(text: Column) -> Column:
    # url_encode differs from percent-encoding with "/" kept safe in four characters.
    out = F.url_encode(text)
    for old, new in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def _unquote(text: Column) -> Column:
    # "+" is an ordinary character here and a stray "%" stays as it is.
    guarded = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))


def encode_key(key: Column) -> Column:
    """Percent-encode twice, so that a key with slashes becomes one path segment group."""
    return _quote(_quote(key))


def decode_key(key: Column) -> Column:
    return _unquote(_unquote(key))


def strip_affixes(text: Column, prefix: str = "", suffix: str = "") -> Column:
    """Cut by length, not by match."""
    keep = F.length(text) - F.lit(len(prefix) + len(suffix))
    return F.substring(text, F.lit(len(prefix) + 1), F.greatest(keep, F.lit(0)))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def file_id(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def extension(path: Column) -> Column:
    """Last suffix with its dot; empty when there is none."""
    return F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    name = base_name(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(extension(path)))


def parent(path: Column) -> Column:
    """Name of the folder that holds the file."""
    return F.when(
        F.contains(path, F.lit("/")),
        base_name(F.substring(path, F.lit(1), F.length(path) - F.length(base_name(path)) - 1)),
    ).otherwise(F.lit(""))


def collection_storage_path(path: Column) -> Column:
    """``struct(path, error)``: slashes trimmed and collapsed, unsafe or empty paths refused."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    error = F.when(
        F.coalesce(F.size(parts), F.lit(0)) <= 0,
        F.lit("collection path cannot resolve to an empty storage path"),
    ).when(
        F.exists(parts, lambda p: p.isin(".", "..")),
        F.concat(F.lit("collection path contains unsafe segment: "), path),
    )
    return F.struct(
        F.when(error.isNull(), F.array_join(parts, "/")).alias("path"), error.alias("error")
    )


def processed_storage_path(storage_path: Column) -> Column:
    parts = F.filter(F.split(storage_path, "/"), lambda p: p != "")
    marked = F.transform(
        parts, lambda p: F.when(p.endswith("_pickle"), p).otherwise(F.concat(p, F.lit("_pickle")))
    )
    return F.when(F.size(parts) > 0, F.array_join(marked, "/"))


def raw_storage_path(storage_path: Column, doc_id: Column, ext: Column, file_name: Column) -> Column:
    """``struct(path, error)`` for ``<storage>/<doc_id><ext>``."""
    chosen = F.coalesce(F.nullif(ext, F.lit("")), extension(file_name))
    dotted = F.when(chosen.startswith("."), chosen).otherwise(F.concat(F.lit("."), chosen))
    error = F.when(
        F.coalesce(chosen, F.lit("")) == "",
        F.lit("document file extension is required for raw storage path"),
    ).when(
        F.contains(dotted, F.lit("/")) | F.contains(dotted, F.lit("\\")) | dotted.isin(".", ".."),
        F.concat(F.lit("unsafe document file extension: "), dotted),
    )
    path = F.concat(storage_path, F.lit("/"), doc_id.cast("string"), dotted)
    return F.struct(F.when(error.isNull(), path).alias("path"), error.alias("error"))


_URI = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"

# Hosts of a nas: address that name the root and not a folder below it.
ROOT_HOSTS = ["kb", "raw"]


def resolve_raw_uri(uri: Column, root: str) -> Column:
    """``struct(path, error)`` for plain, ``file:`` and ``nas:`` addresses."""
    scheme = F.lower(F.regexp_extract(uri, _URI, 1))
    host = F.regexp_extract(uri, _URI, 2)
    path = _unquote(F.regexp_extract(uri, _URI, 3))
    rel = F.regexp_replace(path, "^/+", "")
    rel = F.when(
        (host != "") & ~host.isin(*ROOT_HOSTS),
        F.when(rel != "", F.concat(host, F.lit("/"), rel)).otherwise(host),
    ).otherwise(rel)
    rel = F.regexp_replace(rel, "^raw/", "")
    under_root = F.when(rel == "", F.lit(root)).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), rel))
    resolved = F.when(scheme == "", uri).when(scheme == "file", path).when(scheme == "nas", under_root)
    error = F.when(resolved.isNull(), F.concat(F.lit("Unsupported raw_uri scheme: "), scheme))
    return F.struct(resolved.alias("path"), error.alias("error"))


def manifest_key(prefix: str, processed_path: Column, doc_id: Column) -> Column:
    return F.concat_ws(
        "/", F.lit(prefix.strip("/")), processed_path, doc_id.cast("string"), F.lit("manifest.json")
    )


def extension_of(content_type: Column) -> Column:
    """File extension of a media type, null for unknown types."""
    known = {t: mimetypes.guess_extension(t) for t in set(mimetypes.types_map.values())}
    pairs = [F.lit(x) for item in sorted(known.items()) for x in item]
    return F.try_element_at(F.create_map(*pairs), F.lower(content_type))
