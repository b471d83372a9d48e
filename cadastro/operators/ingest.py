"""Ingestion work that is really table work, done as Spark jobs over tables of pages, listings and names.

* :func:`extract_links`   - links out of HTML index pages (regex over the whole page, then explode)
* :func:`parse_listing`   - directory-listing lines -> (release date, name)
* :func:`latest_release`  - newest entry per folder (partial aggregate, no sort, no collect)
* :func:`latest_path`     - newest year folder, then the newest month folder in it, ... (level by level)
* :func:`fetch_plan`      - which files still need fetching (anti-join against what exists)
* :func:`split_codebooks` - a long (sheet, code, description) table -> one codebook per known sheet
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .._cols import as_col
from ..operators.lookups import lookup, profile_dimensions
from ..session import checkpoint_root

# An <a ...> tag's href value: double quoted, single quoted or bare (case-insensitive names).
ANCHOR_HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
# The character references that occur in URLs, with '&' itself decoded last.
HREF_ENTITIES = (("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"),
                 ("&#38;", "&"), ("&amp;", "&"))


def extract_links(pages: DataFrame, html_col: str = "html", suffix: str | None = None, keep=("page_id",)) -> DataFrame:
    """One row per ``<a href>`` in each page: ``(*keep, link)``, character references decoded.

    ``suffix`` keeps only links that end with it (``'.zip'`` for an archive index). Whole pages are
    scanned; nothing is truncated. Values may be in double quotes, single quotes or none.
    """
    html = F.col(html_col)
    # The page is searched once for whole tags; of a tag's three groups exactly one is set (or the value is empty).
    tags = F.regexp_extract_all(html, F.lit(ANCHOR_HREF), F.lit(0))
    value = F.transform(tags, lambda tag: F.regexp_replace(tag, ANCHOR_HREF, "$1$2$3"))
    out = pages.select(*keep, F.explode(value).alias("link"))
    link = F.col("link")
    for entity, char in HREF_ENTITIES:
        link = F.replace(link, F.lit(entity), F.lit(char))
    out = out.withColumn("link", link)
    if suffix:
        out = out.filter(F.col("link").endswith(suffix))
    return out


def parse_listing(listing: DataFrame, line_col: str = "line", date_format: str = "MM-dd-yy") -> DataFrame:
    """Listing lines such as ``'01-15-24  10:30AM   <DIR>   2024'`` -> add ``release_date`` and ``name``.

    Runs of blanks collapse to one, the line is split on blanks; the first field is the date, the last
    the name. A line whose first field is not a date gets a null ``release_date``.
    """
    parts = F.split(F.regexp_replace(F.trim(as_col(line_col)), " +", " "), " ")
    first = F.get(parts, 0)
    date = month_day_short_year(first) if date_format == "MM-dd-yy" else F.try_to_date(first, date_format)
    return listing.withColumns({"release_date": date, "name": F.element_at(parts, -1)})


# Fixed value: two-digit years from this value up are 19xx, below it 20xx (the POSIX strptime pivot).
SHORT_YEAR_PIVOT = 69


def month_day_short_year(c) -> F.Column:
    """``'MM-dd-yy'`` -> date with the POSIX two-digit-year pivot ('99' -> 1999, '24' -> 2024).

    Spark's own ``yy`` maps every two-digit year into 2000-2099, which would put a 1999 release after
    every later one. Anything not shaped ``dd-dd-dd`` or not a real date gives null.
    """
    c = as_col(c)
    yy = F.substring(c, 7, 2).try_cast("int")
    year = F.when(yy >= SHORT_YEAR_PIVOT, yy + 1900).otherwise(yy + 2000)
    iso = F.concat(year.cast("string"), F.lit("-"), F.substring(c, 1, 5))
    return F.when(c.rlike(r"^[0-9]{2}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(iso, "yyyy-MM-dd"))


def latest_release(parsed: DataFrame, folder_col: str = "folder") -> DataFrame:
    """Newest ``name`` per folder by ``release_date``; ties broken by the larger name (deterministic).

    ``max`` over a struct is a partial aggregate: each task keeps one candidate per folder before the
    shuffle, so a folder holding most of the rows costs no more than any other.
    """
    # Rows without a date are dropped *after* the aggregate: in a struct maximum a null date sorts below
    # every date, so a folder's best row is dated whenever any of its rows is. (Filtering first would
    # have Spark evaluate the whole line parse twice, once in the pushed-down filter.)
    best = F.max(F.struct(F.col("release_date"), F.col("name"))).alias("best")
    return (
        parsed.groupBy(folder_col)
        .agg(best)
        .filter(F.col("best.release_date").isNotNull())
        .select(folder_col, F.col("best.name").alias("name"), F.col("best.release_date").alias("release_date"))
    )


def _inside(level: DataFrame, chosen: DataFrame, folder_col: str) -> DataFrame:
    """Entries of ``level`` that lie in a chosen folder. Folders are compared by full path (root and all),
    so equal names below different roots stay apart; the chosen side has one row per folder and goes
    through the checked lookup: broadcast under the measured bound, a salted join above it."""
    keyed = chosen.select(F.concat_ws("/", "root", "path").alias(folder_col), "root", "path")
    return lookup(level, keyed, folder_col, "inner", name="chosen folders")


def latest_path(levels, folder_col: str = "folder") -> DataFrame:
    """Descend a folder tree by newest release: newest entry at level 0, then the newest entry inside
    it at level 1, and so on (e.g. newest year folder, then newest month folder in that year).

    ``levels`` are parsed listings (:func:`parse_listing`); the ``folder`` of an entry is the full path of
    the folder it sits in: a root at level 0, ``root/name`` at level 1, ``root/name/name`` at level 2. Each
    step is a partial aggregate plus a checked lookup of the one row per folder chosen before, so no level
    is collected to the driver. Returns one row per root: ``(root, path, name, release_date)``, ``path``
    joining the chosen names with '/'. Each level's choice is checkpointed, so every listing is read once.
    """
    chosen = latest_release(levels[0], folder_col).select(
        F.col(folder_col).alias("root"), F.col("name").alias("path"), "name", "release_date")
    for level in levels[1:]:
        chosen = _kept(chosen)
        best = F.max(F.struct(F.col("release_date"), F.col("name"))).alias("best")
        chosen = (
            _inside(level, chosen, folder_col).groupBy("root", "path")
            .agg(best)
            .filter(F.col("best.release_date").isNotNull())
            .select("root", F.concat_ws("/", "path", "best.name").alias("path"), F.col("best.name").alias("name"),
                    F.col("best.release_date").alias("release_date"))
        )
    return chosen


def release_files(levels, files: DataFrame, folder_col: str = "folder") -> DataFrame:
    """Every entry listed in the newest release folder of each root: ``(root, path, name)``.

    ``levels`` are as in :func:`latest_path`; ``files`` is the parsed listing one level below, its
    ``folder`` the full path of the folder a file lies in. The result is what :func:`fetch_plan` takes.
    """
    return _inside(files, _kept(latest_path(levels, folder_col)), folder_col).select("root", "path", "name")


def _kept(df: DataFrame) -> DataFrame:
    """``df`` checkpointed to the shared folder: what a profile and a join both read is worked out once."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def newest_paths(listing: DataFrame, folder_col: str = "folder", is_folder: str = "is_folder", max_depth: int = 1000) -> DataFrame:
    """Descend from every root by newest sub-folder, as deep as folders go: (root, path, name, release_date, depth).

    ``listing`` holds the parsed lines (:func:`parse_listing`) of all folders in one table, ``is_folder`` telling
    which entries are folders; an entry's ``folder`` is the full path it sits in. A root is a folder that is no
    entry of another. The listing is read once, for one row per folder (its newest sub-folder); the descent
    follows those rows, all roots a level a step, until none goes on. Roots without a dated sub-folder give no
    row; a tree deeper than ``max_depth`` is an error (links that lead back up would never end).
    """
    folders = listing.where(F.col(is_folder)).select(F.col(folder_col).alias("folder"), "name", "release_date")
    inside = F.concat_ws("/", "folder", "name")
    best = F.max(F.struct("release_date", "name")).alias("best")
    newest = _kept(folders.groupBy("folder").agg(best).where(F.col("best.release_date").isNotNull()).select(
        "folder", F.col("best.name").alias("next"), F.col("best.release_date").alias("next_date")))
    below = folders.select(inside.alias("folder")).distinct()
    roots = newest.select("folder").join(below, "folder", "left_anti")
    at = _kept(roots.select(F.col("folder").alias("root"), "folder", F.lit("").alias("path"), F.lit(None).cast("string").alias("name"),
                            F.lit(None).cast("date").alias("release_date"), F.lit(0).alias("depth")))
    profile = profile_dimensions({"folder": (newest, "folder")})["folder"]
    done = at.limit(0)
    while at.limit(1).count():
        if at.agg(F.max("depth")).first()[0] > max_depth:
            raise RuntimeError(f"folders nest deeper than {max_depth}")
        step = _kept(lookup(at, newest, "folder", "left", profile=profile, name="newest sub-folders"))
        done = done.unionByName(step.where(F.col("next").isNull()).drop("next", "next_date"))
        at = step.where(F.col("next").isNotNull()).select(
            "root", F.concat_ws("/", "folder", "next").alias("folder"),
            F.when(F.col("path") == "", F.col("next")).otherwise(F.concat_ws("/", "path", "next")).alias("path"),
            F.col("next").alias("name"), F.col("next_date").alias("release_date"), (F.col("depth") + 1).alias("depth"))
    return done.select("root", "path", "name", "release_date", "depth")


def fetch_plan(manifest: DataFrame, existing: DataFrame, name_col: str = "name", archive_suffix: str = ".zip",
               overwrite: bool = False) -> DataFrame:
    """Files of ``manifest`` to fetch: those for which neither the archive nor its unpacked folder exists.

    ``existing`` lists names already present (archives and folders). With ``overwrite`` every manifest
    entry is fetched again. ``existing`` is reduced to distinct base names first (a partial aggregate),
    then anti-joined on the base name.
    """
    if overwrite:
        return manifest

    def base(c):
        return F.regexp_replace(c, F.lit(_literal_suffix(archive_suffix)), F.lit(""))

    have = existing.select(base(F.col(name_col)).alias("_base")).distinct()
    return (
        manifest.withColumn("_base", base(F.col(name_col)))
        .join(have, "_base", "left_anti")
        .drop("_base")
    )


def _literal_suffix(suffix: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in suffix) + "$"


def split_codebooks(long: DataFrame, sheet_files: Mapping[str, str], sheet_col: str = "sheet",
                    code_col: str = "code", description_col: str = "description") -> DataFrame:
    """Long codebook table -> ``(codebook, code, description)`` for the known sheets only.

    Sheet names are compared lower-cased; ``sheet_files`` maps a sheet to its codebook file
    (``{'região': 'regiao.csv'}``), the codebook name being the file name without ``.csv``. Unknown
    sheets are dropped. Write the result with ``partition_by='codebook'`` to get one folder per codebook.
    """
    spark = long.sparkSession
    names = spark.createDataFrame(
        [(s.lower(), f.removesuffix(".csv")) for s, f in sheet_files.items()], "sheet_key string, codebook string"
    )
    keyed = long.withColumn("sheet_key", F.lower(F.col(sheet_col)))
    # the name map is a fixed, tiny table: a checked broadcast lookup
    joined = lookup(keyed, names, "sheet_key", "inner", name="codebook sheets")
    return joined.select("codebook", F.col(code_col).alias("code"), F.col(description_col).alias("description"))


def codebook_frames(split: DataFrame, names) -> dict[str, DataFrame]:
    """Per-codebook frames ``(cod_<name>, <name>)`` from :func:`split_codebooks` output (lazy filters)."""
    return {
        n: split.filter(F.col("codebook") == n).select(F.col("code").alias(f"cod_{n}"), F.col("description").alias(n))
        for n in names
    }
