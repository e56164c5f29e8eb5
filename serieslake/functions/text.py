"""Column functions for padded text: trimming, typing, labels and links."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(column: str | Column) -> Column:
    """Strip the space padding."""
    return F.trim(column)


def to_type(column: str | Column, dtype: str) -> Column:
    """Trimmed text as ``dtype``; NULL where it does not parse."""
    return clean(column).try_cast(dtype)


def instant(at: dt.datetime) -> Column:
    """A run time as a timestamp; without a zone it is read in the session's zone, as stored text is."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def unparsed(column: str | Column, dtype: str) -> Column:
    """True where text is present but does not parse as ``dtype``."""
    text = clean(column)
    return text.isNotNull() & (text != "") & text.try_cast(dtype).isNull()


def present(column: str | Column) -> Column:
    """Neither NULL nor blank."""
    text = clean(column)
    return text.isNotNull() & (text != "")


def or_text(column: str | Column, fallback: str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column, F.lit(fallback))


def label(template: str, parts: dict[str, Column]) -> Column:
    """Fill ``{name}`` slots of a template with columns: ``label("{a} ({b})", {...})``."""
    pieces: list[Column] = []
    rest = template
    while rest:
        text, opened, tail = rest.partition("{")
        if text:
            pieces.append(F.lit(text))
        if not opened:
            break
        name, _, rest = tail.partition("}")
        pieces.append(parts[name])
    return F.concat(*pieces)


def fold_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of a path that starts with a slash."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, seg: F.when(seg == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(seg == ".", done)
        .otherwise(F.concat(done, F.array(seg))),
    )
    closing = F.when(last.isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), closing)


def resolve_link(base: str | Column, href: str | Column) -> Column:
    """The absolute address of ``href`` as found on the page ``base``."""
    base = F.col(base) if isinstance(base, str) else base
    href = F.col(href) if isinstance(href, str) else href
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    folder = F.concat(F.lit("/"), F.regexp_replace(F.regexp_extract(page, r"^(.*/)", 1), "^/", ""))
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    suffix = F.regexp_extract(href, r"^[^?#]*(.*)$", 1)
    query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", base)
        .when(href.startswith("?"), F.concat(site, page, href))
        .when(href.startswith("#"), F.concat(site, page, query, href))
        .when(href.startswith("/"), F.concat(site, fold_dots(path), suffix))
        .otherwise(F.concat(site, fold_dots(F.regexp_replace(F.concat(folder, path), "/{2,}", "/")), suffix))
    )
