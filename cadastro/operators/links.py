"""Link resolution in column expressions: RFC 3986 references against a page's URL, in a normal form.

A link on a page is a reference (``../dados/f.zip``, ``//host/f.zip``, ``?page=2``); only with the page's URL does
it name a file that can be fetched or compared. Everything here is native expressions: five parts by one
regular expression each, the transformation of section 5.2, dot segments by an array fold, and the normal
form of section 6.2 (case, percent signs, default ports, empty paths), so that equal targets are equal strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .._cols import as_col

# Scheme, authority, path, query, fragment (RFC 3986, appendix B, with the scheme's own characters).
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_HAS_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"
_HAS_QUERY = r"(?s)^[^#]*\?"
# The ports that URLs of these schemes leave out.
DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21"}


def url_parts(url: Column) -> dict[str, Column]:
    """scheme, authority, path, query of a URL or reference; a part that is not there is null (the path is '')."""
    part = lambda g: F.regexp_extract(url, _PARTS, g)
    return {
        "scheme": F.when(part(1) != "", F.lower(part(1))), "authority": F.when(url.rlike(_HAS_AUTHORITY), part(2)),
        "path": part(3), "query": F.when(url.rlike(_HAS_QUERY), part(4)),
    }


def remove_dot_segments(path: Column) -> Column:
    """``/a/./b/../c`` -> ``/a/c``; a path that ends in a dot segment ends in ``/``."""
    rooted = path.startswith("/")
    segments = F.split(F.when(rooted, F.substr(path, F.lit(2))).otherwise(path), "/", -1)
    folded = F.aggregate(segments, F.array().cast("array<string>"), lambda kept, s: F.when(s == ".", kept).when(
        s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.array_append(kept, s)))
    last = F.element_at(segments, -1)
    whole = F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)
    return F.concat(F.when(rooted, F.lit("/")).otherwise(F.lit("")), F.array_join(whole, "/"))


def _encoded(text: Column) -> Column:
    """Characters that are not visible ASCII as the escapes of their UTF-8 bytes."""
    each = F.transform(F.split(text, ""), lambda ch: F.when(
        ch.rlike("[^!-~]"), F.regexp_replace(F.hex(F.encode(ch, "UTF-8")), "(..)", "%$1")).otherwise(ch))
    return F.when(text.rlike("[^!-~]"), F.array_join(each, "")).otherwise(text)


def _escapes(text: Column) -> Column:
    """Escapes in upper case, escaped letters, digits and ``-._~`` decoded."""
    def escape(piece: Column, i: Column) -> Column:
        code = F.upper(F.substring(piece, 1, 2))
        char = F.chr(F.conv(code, 16, 10).cast("int"))
        decoded = F.when(char.rlike(r"^[A-Za-z0-9\-._~]$"), char).otherwise(F.concat(F.lit("%"), code))
        return F.when(i == 0, piece).when(piece.rlike("^[0-9A-Fa-f]{2}"), F.concat(decoded, F.substr(piece, F.lit(3)))).otherwise(
            F.concat(F.lit("%"), piece))

    return F.when(text.contains("%"), F.array_join(F.transform(F.split(text, "%", -1), escape), "")).otherwise(text)


def resolved_links(links: DataFrame, link_col: str = "link", base_col: str = "url", out: str = "target") -> DataFrame:
    """``links`` (see :func:`cadastro.operators.ingest.extract_links`, with the page's URL kept) plus each link's
    target: the reference resolved against the page's absolute URL, normalised, without its fragment.

    Null if the link or the URL is null. Blanks around either are dropped, as browsers do. Targets of other
    schemes (``mailto:``) come back with their scheme in lower case. The steps are projections one upon the
    other, so that no part is worked out twice.
    """
    r, b, t = (F.col(f"_cadastro_{x}") for x in "rbt")
    step = links.withColumns({"_cadastro_r": F.trim(as_col(link_col)), "_cadastro_b": F.trim(as_col(base_col))})
    step = step.withColumns({f"_cadastro_{x}": F.struct(*[e.alias(n) for n, e in url_parts(c).items()]) for x, c in (("r", r), ("b", b))})
    absolute, own_host, own_path = r["scheme"].isNotNull(), r["authority"].isNotNull(), r["path"] != ""
    folder = F.when(b["authority"].isNotNull() & (b["path"] == ""), F.lit("/")).otherwise(F.regexp_replace(b["path"], "[^/]*$", ""))
    merged = F.when(r["path"].startswith("/"), r["path"]).otherwise(F.concat(folder, r["path"]))
    step = step.withColumn("_cadastro_t", F.struct(
        F.coalesce(r["scheme"], b["scheme"]).alias("scheme"),
        F.when(absolute | own_host, r["authority"]).otherwise(b["authority"]).alias("authority"),
        F.when(absolute | own_host, r["path"]).when(own_path, merged).otherwise(b["path"]).alias("path"),
        F.when(absolute | own_host | own_path, r["query"]).otherwise(F.coalesce(r["query"], b["query"])).alias("query"),
        absolute.alias("absolute"), (r["path"].isNotNull() & b["path"].isNotNull()).alias("known")))
    # Dots are segments of a hierarchy; a path like that of mailto: is none.
    hierarchy = t["authority"].isNotNull() | t["path"].startswith("/") | ~t["absolute"]
    host, path, query, port = (F.col(f"_cadastro_{x}") for x in ("host", "path", "query", "port"))
    step = step.withColumns({
        "_cadastro_path": F.when(hierarchy, remove_dot_segments(t["path"])).otherwise(t["path"]),
        "_cadastro_host": F.regexp_replace(F.lower(F.regexp_replace(t["authority"], "^.*@", "")), ":$", ""),
        "_cadastro_port": F.try_element_at(F.create_map(*[F.lit(f":{x}" if k % 2 else x) for k, x in enumerate(sum(DEFAULT_PORTS.items(), ()))]), t["scheme"])})
    step = step.withColumns({
        "_cadastro_path": _encoded(path), "_cadastro_query": _encoded(t["query"]),
        "_cadastro_host": F.when(host.endswith(port), F.substr(host, F.lit(1), F.length(host) - F.length(port))).otherwise(host)})
    step = step.withColumns({"_cadastro_path": _escapes(path), "_cadastro_query": _escapes(query)})
    authority = F.concat(F.lit("//"), F.regexp_extract(t["authority"], "^(.*@)?", 1), host)
    none = F.lit("")
    target = F.concat(F.coalesce(F.concat(t["scheme"], F.lit(":")), none), F.coalesce(authority, none),
                      F.when(t["authority"].isNotNull() & (path == ""), F.lit("/")).otherwise(path),
                      F.coalesce(F.concat(F.lit("?"), query), none))
    named = step.withColumn(out, F.when(t["known"], target))
    return named.drop(*[f"_cadastro_{x}" for x in ("r", "b", "t", "path", "host", "port", "query")])


def link_manifest(resolved: DataFrame, suffix: str = ".zip", target_col: str = "target") -> DataFrame:
    """What :func:`cadastro.operators.ingest.fetch_plan` takes: one row (name, target) per file that any page links to.

    The name is the target's last path segment, the suffix is looked for in the path (a query after it is no
    matter), and a file linked from many pages comes once (a partial aggregate).
    """
    path = F.regexp_extract(target_col, _PARTS, 3)
    return resolved.where(path.endswith(suffix)).groupBy(F.col(target_col).alias("target")).agg(
        F.max(F.regexp_extract(path, "([^/]*)$", 1)).alias("name")).select("name", "target")
