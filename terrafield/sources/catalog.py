"""Catalogues of stores as tables: search, look-up, append, publication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Columns of a model catalogue.
GCM_COLUMNS = ("activity_id", "institution_id", "source_id", "experiment_id", "member_id", "table_id", "variable_id", "grid_label", "zstore", "dcpp_init_year", "version")


def search(catalog: DataFrame, **facets) -> DataFrame:
    """Rows whose facets equal a value or are among several."""
    for column, wanted in facets.items():
        if wanted is not None:
            wanted = wanted if isinstance(wanted, (list, tuple, set)) else [wanted]
            catalog = catalog.filter(F.col(column).isin(list(wanted)))
    return catalog


def exactly_one(found: DataFrame, column: str = "zstore") -> str:
    """The one store of a search; anything else is an error."""
    rows = found.select(column).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"a search must find one store, not {'none' if not rows else 'several'}")
    return rows[0][0]


def lookup(catalog: DataFrame, facets: dict, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key, in a stated order, among rows with given facets."""
    found = search(catalog, **facets)
    return found.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def append_catalog(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Both catalogues' rows, one a key; newer rows win, then the stated order."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    over = Window.partitionBy(*keys).orderBy(F.desc("_new"), *order)
    return both.withColumn("_n", F.row_number().over(over)).filter("_n = 1").drop("_n", "_new")


def open_model(catalog: DataFrame, scale: dict[str, float] | None = None, **facets) -> DataFrame:
    """The one store that the facets name, with variables of other units scaled (precipitation by 86400, say)."""
    from .readers import scan

    scenario = facets.get("experiment_id")
    if isinstance(scenario, str) and "activity_id" not in facets:
        facets["activity_id"] = "CMIP" if scenario == "historical" else "ScenarioMIP"
    df = scan(catalog.sparkSession, exactly_one(search(catalog, **facets)))
    return df.withColumns({c: F.col(c) * F.lit(k) for c, k in (scale or {}).items() if c in df.columns})


def assets(catalog: DataFrame, **facets) -> DataFrame:
    """(key, zstore): the first store of each model, member and experiment."""
    key = F.concat_ws(".", "source_id", "member_id", "experiment_id").alias("key")
    return search(catalog, **facets).groupBy(key).agg(F.min("zstore").alias("zstore"))


def activity_of(scenario: Column) -> Column:
    return F.when(scenario == "historical", "CMIP").otherwise("ScenarioMIP")


def parse_paths(paths: DataFrame, parts: dict[str, int], patterns: dict[str, tuple[str, int]], path: str = "path") -> DataFrame:
    """Columns out of paths: parts between slashes by place (from 1, or from the end by negative ones), and groups of patterns."""
    split = F.split(path, "/")
    out = paths
    for name, at in parts.items():
        out = out.withColumn(name, F.try_element_at(split, F.lit(at)))
    for name, (pattern, group) in patterns.items():
        out = out.withColumn(name, F.regexp_extract(path, pattern, group))
    return out


#: The parts of a published dataset's name.
NAME_PARTS = ("activity_id", "institution_id", "source_id", "experiment_id", "member_id", "timescale", "method", "variable_id")


def parse_name(df: DataFrame, name: str = "name") -> DataFrame:
    """Columns of a dataset name of eight parts joined by points."""
    parts = F.split(name, r"\.")
    return df.select("*", *[F.try_element_at(parts, F.lit(i + 1)).alias(p) for i, p in enumerate(NAME_PARTS)])


def file_patterns(spark: SparkSession, first: int, last: int, variables: Sequence[str], pattern: str) -> DataFrame:
    """Every year, month and variable with its path."""
    rows = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
    rows = rows.withColumn("variable", F.explode(F.array(*map(F.lit, variables))))
    return rows.withColumn("path", F.format_string(pattern, "year", "month", "variable"))


#: Addresses of the licences that data come under.
LICENSE_URLS = {
    "CC-BY-4.0": "https://creativecommons.org/licenses/by/4.0/",
    "CC-BY-SA-4.0": "https://creativecommons.org/licenses/by-sa/4.0/",
    "CC0-1.0": "https://creativecommons.org/publicdomain/zero/1.0/",
}


def with_license(catalog: DataFrame, licenses: DataFrame, derived: bool = False) -> DataFrame:
    """license and license_url by ``licenses`` (source_id, license; some hundred rows); what derives from a permissive source comes under CC-BY-4.0."""
    out = catalog.join(F.broadcast(licenses), "source_id", "left")
    if derived:
        out = out.withColumn("license", F.when(F.col("license").isin("CC0-1.0", "CC-BY-4.0"), "CC-BY-4.0").otherwise(F.col("license")))
    urls = F.create_map(*[F.lit(x) for pair in LICENSE_URLS.items() for x in pair])
    return out.withColumn("license_url", urls[F.col("license")])


def filter_versions(results: DataFrame, minimum: str | None = None, maximum: str | None = None, without_local: bool = False, version: str = "version") -> DataFrame:
    """Results with a version of at least one and at most another, perhaps without local builds (a + in the version)."""
    from ..functions.scalar import semver

    own = semver(F.col(version))
    if minimum:
        results = results.filter(own >= semver(F.lit(minimum)))
    if maximum:
        results = results.filter(own <= semver(F.lit(maximum)))
    return results.filter(~F.col(version).contains("+")) if without_local else results


def latest(results: DataFrame, keys: Sequence[str], version: str = "version") -> DataFrame:
    """Each key's result of the highest version."""
    from ..functions.scalar import semver

    over = Window.partitionBy(*keys).orderBy(F.desc(semver(F.col(version))), F.desc(version))
    return results.withColumn("_n", F.row_number().over(over)).filter("_n = 1").drop("_n")


def https_of(uri: Column, root: str) -> Column:
    """The address under ``root`` of what a store's own address (scheme://place) names; null for none."""
    return F.concat(F.lit(root.rstrip("/") + "/"), F.element_at(F.split(uri, "//"), -1))


def web_catalog(runs: DataFrame, root: str, cdn: str, minimum: str | None = None, maximum: str | None = None) -> DataFrame:
    """What a page of published pyramids is given: the newest run of each name within the versions wanted, the name's parts, and addresses.

    ``runs`` has name, version, pyramid and daily (addresses of stores, perhaps null). ``source`` leads to the pyramid through ``cdn``, ``original`` to the daily data
    under ``root``. Local builds are left out, and so are names that do not have all their parts.
    """
    newest = latest(filter_versions(runs, minimum, maximum, without_local=True), ["name"])
    named = parse_name(newest).filter((F.size(F.split("name", r"\.")) == len(NAME_PARTS)) & F.col("pyramid").isNotNull())
    return named.select("name", *NAME_PARTS, "version", https_of(F.col("pyramid"), cdn).alias("source"), https_of(F.col("daily"), root).alias("original"))


def report(df: DataFrame) -> DataFrame:
    """One row: the distinct values of every column."""
    return df.agg(*[F.count_distinct(c).alias(c) for c in df.columns])
