"""Survey files in, slim Parquet tables out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelweave.functions import columns as C
from panelweave.registry import Registry
from panelweave.sources import versions


FILE = "_file"


def scan_csv(spark: SparkSession, path: str | list[str], columns: Iterable[str], with_file: bool = False) -> DataFrame:
    """Wanted columns of a CSV file as text, names matched without case and lower-cased.

    Columns the file lacks are left out. A folder of files counts as one file;
    its files must agree in their headers, otherwise the job fails. A doubled quote
    in a quoted field is a quote. A field holds no line break, so that large files
    can be read by many tasks. ``with_file`` adds the path of each row's file.
    """
    wanted = {c.lower() for c in columns}
    raw = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)
    found = [F.col(f"`{c}`").alias(c.lower()) for c in raw.columns if c.lower() in wanted]
    return raw.select(*found, *([F.col("_metadata.file_path").alias(FILE)] if with_file else []))


def typed_keys(df: DataFrame, key: str) -> DataFrame:
    """Entity id and year as whole numbers, also when written as ``12.0``."""
    whole = {c: C.whole_number(c) for c in (key, "syear") if c in df.columns}
    return df.withColumns(whole).withColumns({c: F.col(c).cast("int") for c in whole if c == "syear"})


def clean_values(df: DataFrame, key: str) -> DataFrame:
    """Every non-key column to double, ids to whole numbers, missing codes to null."""
    cleaned = []
    for c, kind in df.dtypes:
        if c in (key, "syear", FILE):
            value = F.col(c)
        elif c in ("pid", "hid"):
            value = C.identifier(c)
        else:
            value = C.clean(c, kind == "string")
        cleaned.append(value.alias(c))
    return df.select(cleaned)


def harmonise(df: DataFrame, registry: Registry, dataset: str) -> DataFrame:
    """Add the harmonised columns of a dataset and drop the versions they come from."""
    rules = [h for h in registry.harmonised if h.dataset == dataset]
    out = df.withColumns({
        h.name.lower(): C.first_version(
            (F.col(source.lower()), mapping) for source, mapping in h.sources if source.lower() in df.columns
        )
        for h in rules
    }) if rules else df
    return out.drop(*{source.lower() for h in rules for source, _ in h.sources})


def extract(
    spark: SparkSession, registry: Registry, dataset: str, files: list[str] | None = None, with_file: bool = False
) -> DataFrame:
    """Slim table of one dataset, straight from its CSV or from some of its files."""
    key = registry.entity_key(dataset)
    raw = scan_csv(spark, files or registry.csv_path(dataset), {key, "syear"} | registry.raw_columns()[dataset], with_file)
    return harmonise(clean_values(typed_keys(raw, key), key), registry, dataset)


def write_by_year(df: DataFrame, path: str) -> None:
    """Parquet partitioned by year.

    The rebalance hint gives few, evenly sized files per year and splits a year
    that holds most of the rows.
    """
    df.hint("rebalance", "syear").write.mode("overwrite").partitionBy("syear").parquet(path)


def table_path(folder: str, dataset: str) -> str:
    return f"{folder.rstrip('/')}/{dataset}.parquet"


def stored_schema(spark: SparkSession, path: str):
    """Schema of a stored table, None when there is none."""
    version = versions.latest(spark, path)
    return version.schema if version else None


def write_version(df: DataFrame, path: str) -> DataFrame:
    """Make ``df`` the next version of the table at ``path``; the same rows, read from the written version."""
    spark = df.sparkSession
    version = versions.commit(spark, path, versions.latest(spark, path), df.schema, lambda to: write_by_year(df, to))
    return versions.read(spark, path, version)


def refresh(spark: SparkSession, registry: Registry, folder: str, when: str = "stale") -> list[str]:
    """Extract the datasets that need it and return their names.

    ``missing``: only those without a table; ``stale``: also those whose table
    lacks a required column, and those whose files have changed, of which only the
    years in changed files are read again; ``force``: all.
    """
    if when not in ("missing", "stale", "force"):
        raise ValueError(f"unknown refresh mode {when!r}")
    done = []
    for dataset in registry.datasets():
        path = table_path(folder, dataset)
        before = versions.latest(spark, path)
        if before is not None and when == "missing":
            continue
        now = versions.source_files(spark, registry.csv_path(dataset))
        if before is None or when == "force" or not registry.stored_columns(dataset) <= set(before.schema.names):
            _extract_version(spark, registry, dataset, path, before, now)
        else:
            old = {f: {k: v for k, v in s.items() if k != "years"} for f, s in before.sources.items()}
            if old == now:
                continue
            _extract_version(spark, registry, dataset, path, before, now, {f for f in now if old.get(f) != now[f]})
        done.append(dataset)
    return done


def _extract_version(spark, registry, dataset, path, before, now, changed: set[str] | None = None) -> None:
    """Commit a version of a dataset from its files ``now``.

    With ``changed`` files only the years that these hold, or that they or files now gone held before, are
    written; a year is read from every file that has rows of it.
    """
    files, years, kept = None, None, {}
    if changed is not None:
        kept = {f: set(before.sources[f]["years"]) for f in now if f not in changed}
        years = {y for f, s in before.sources.items() if f not in kept for y in s["years"]}
        if changed:
            fresh = typed_keys(scan_csv(spark, sorted(changed), ["syear"]), registry.entity_key(dataset))
            years |= {r.syear for r in fresh.select("syear").distinct().collect()}
        files = sorted(changed | {f for f, held in kept.items() if held & years})
    if files == []:  # all files with these years are gone
        df, seen, schema = None, None, before.schema
    else:
        df = extract(spark, registry, dataset, files, with_file=True)
        if years is not None:
            known = F.col("syear").isin([y for y in years if y is not None])
            df = df.filter(F.when(F.col("syear").isNull(), None in years).otherwise(known))
        # which file holds which years is noted while the rows are written
        seen = Observation()
        df = df.observe(seen, F.collect_set(F.struct(FILE, "syear")).alias("years")).drop(FILE)
        schema = df.schema

    def sources() -> dict[str, dict]:
        held = {f: set(of) for f, of in kept.items()}
        for file, year in seen.get["years"] if seen is not None else ():
            held.setdefault(versions.file_key(file), set()).add(year)
        return {f: {**s, "years": sorted(held.get(f, ()), key=lambda y: (y is None, y))} for f, s in now.items()}

    def write(to: str) -> None:
        if df is not None:
            write_by_year(df, to)

    replaced = None if years is None else {f"syear={'__HIVE_DEFAULT_PARTITION__' if y is None else y}" for y in years}
    versions.commit(spark, path, before, schema, write, replaced, sources)


def load(spark: SparkSession, registry: Registry, folder: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Stored tables with the columns the registry names: (person tables, household tables)."""
    person, household = [], []
    for dataset in registry.datasets():
        path = table_path(folder, dataset)
        version = versions.latest(spark, path)
        if version is None:
            raise FileNotFoundError(f"no table for dataset {dataset!r} at {path}")
        key = registry.entity_key(dataset)
        wanted = [key, "syear"] + sorted(registry.stored_columns(dataset) - {key, "syear"})
        df = versions.read(spark, path, version).select([c for c in wanted if c in version.schema.names])
        (household if key == "hid" else person).append(df)
    return person, household


def with_labels(df: DataFrame, registry: Registry) -> DataFrame:
    """Registry labels as column comments; kept in Parquet schemas."""
    labels = registry.labels()
    for c in df.columns:
        if c in labels:
            df = df.withMetadata(c, {"comment": labels[c]})
    return df


def label_table(spark: SparkSession, registry: Registry) -> DataFrame:
    """Column names and their labels; one row a variable."""
    return spark.createDataFrame(list(registry.labels().items()), "variable string, label string")


def save_master(df: DataFrame, path: str, registry: Registry | None = None) -> DataFrame:
    """Write the master panel and hand back the same rows, read from the written table."""
    return write_version(with_labels(df, registry) if registry else df, path)


def load_master(spark: SparkSession, path: str) -> DataFrame:
    if stored_schema(spark, path) is None:
        raise FileNotFoundError(f"no master panel at {path}; build it first")
    return versions.read(spark, path)


def export_views(master: DataFrame, willing: str = "plb0097") -> dict[str, DataFrame]:
    """The three delivered views: everything, complete rows, complete rows with a yes/no answer."""
    return {
        "full": master,
        "complete": master.na.drop(),
        "eligible": master.filter(F.col(willing).isin(0, 1)).na.drop(),
    }


def save_views(master: DataFrame, folder: str) -> dict[str, DataFrame]:
    """Write the three views as tables by year and read them back."""
    return {name: write_version(view, table_path(folder, name)) for name, view in export_views(master).items()}


def read_variable(spark: SparkSession, path: str, variable: str, key: str = "pid") -> DataFrame:
    """Key and year as whole numbers, and one cleaned variable; without it where the file lacks the variable."""
    variable = variable.lower()
    df = typed_keys(scan_csv(spark, path, [key, "syear", variable]), key)
    if variable not in df.columns or variable in (key, "syear"):
        return df
    return df.withColumn(variable, C.clean(variable))


def states(spark: SparkSession) -> DataFrame:
    """Federal states: code, name, short name."""
    from panelweave.fixed_values import STATES

    return spark.createDataFrame(list(STATES), "state_code int, state_name string, short_name string")
