"""URL helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def path_part_from_end(url, n: int) -> Column:
    """``url.split('/')[-n]`` (F4); null when there are fewer parts."""
    return F.try_element_at(F.split(_c(url), "/"), F.lit(-n))


def url_host(url) -> Column:
    """Third '/'-separated part: host with port, as ``split('/')[2]``.
    ``parse_url(u, 'HOST')`` would drop the port."""
    return F.try_element_at(F.split(_c(url), "/"), F.lit(3))


_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_HAS_AUTH = r"^[A-Za-z][A-Za-z0-9+.\-]*://"


def _drop_empty_middle(segs: Column) -> Column:
    """Drop empty segments between the first and the last (redundant
    slashes that a merge of base directory and relative path creates)."""
    n = F.size(segs)
    return F.when(n > 2, F.concat(F.slice(segs, 1, 1),
                                  F.filter(F.slice(segs, 2, n - 2), lambda x: x != ""),
                                  F.slice(segs, n, 1))).otherwise(segs)


def _remove_dots(mid: Column) -> Column:
    """Resolve '.' and '..' in a list of path segments (RFC 3986 5.2.4): a
    stack is folded over the segments; a trailing '.' or '..' leaves a
    trailing slash."""
    empty = F.array().cast("array<string>")
    stack = F.aggregate(mid, empty, lambda acc, x: F.when(
        x == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .when(x == ".", acc).otherwise(F.array_append(acc, x)))
    last = F.element_at(mid, -1)
    stack = F.when(last.isin(".", ".."), F.array_append(stack, F.lit(""))).otherwise(stack)
    joined = F.array_join(stack, "/")
    # with an authority the path is absolute: a leading '/' is restored even
    # when '..' popped past the root
    return F.when(~joined.startswith("/"), F.concat(F.lit("/"), joined)).otherwise(joined)


def resolve_url(base, ref) -> Column:
    """Resolve ``ref`` against ``base`` as ``urllib.parse.urljoin`` does for
    hierarchical URLs (F6, RFC 3986 section 5.2), entirely in built-in
    expressions: absolute and scheme-relative references, empty, query-only
    and fragment-only references, absolute paths, and relative paths merged
    with the base directory, with dot segments removed."""
    base, ref = _c(base), _c(ref)
    b_scheme = F.regexp_extract(base, _SCHEME, 1)
    b_auth = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    b_path = F.regexp_extract(base, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    b_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)?", 1)
    r_path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    r_query = F.regexp_extract(ref, r"^[^?#]*(\?[^#]*)?", 1)
    r_frag = F.regexp_extract(ref, r"^[^#]*(#.*)?$", 1)
    prefix = F.concat(b_scheme, F.lit("://"), b_auth)
    base_parts = F.split(b_path, "/")
    base_dir = F.when(F.element_at(base_parts, -1) != "",
                      F.slice(base_parts, 1, F.size(base_parts) - 1)).otherwise(base_parts)
    # an absolute path keeps its segments; a relative one is merged with the
    # base directory, whose redundant empty segments are dropped
    segs = F.when(r_path.startswith("/"), F.split(r_path, "/")).otherwise(
        _drop_empty_middle(F.concat(base_dir, F.split(r_path, "/"))))
    merged = F.concat(prefix, _remove_dots(segs), r_query, r_frag)
    return (F.when(base.isNull() | ref.isNull(), F.lit(None).cast("string"))
            .when(ref.rlike(_SCHEME), ref)
            .when(ref == "", base)
            .when(~base.rlike(_HAS_AUTH), ref)
            .when(ref.startswith("//"), F.concat(b_scheme, F.lit(":"), ref))
            .when(r_path == "", F.concat(prefix, b_path,
                                         F.when(r_query != "", r_query).otherwise(b_query), r_frag))
            .otherwise(merged))


def target_file_name(url) -> Column:
    """Download file name: third-from-last and last path parts joined by '_' (H6)."""
    return F.concat(path_part_from_end(url, 3), F.lit("_"), path_part_from_end(url, 1))
