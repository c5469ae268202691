"""S6: does a load target exist? Errors raise: an unknown answer must never
be taken as "missing", since that selects a create-by-overwrite."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from tidewater.sources.files import list_names


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def split_table_name(name: str, default_database: str | None,
                     default_schema: str | None) -> tuple[str | None, str | None, str]:
    """``db.schema.table`` is kept; ``schema.table`` gets the default
    database; a bare name gets both defaults."""
    parts = name.split(".")
    if len(parts) == 3:
        return parts[0], parts[1], parts[2]
    if len(parts) == 2:
        return default_database, parts[0], parts[1]
    if len(parts) == 1:
        return default_database, default_schema, parts[0]
    raise ValueError(f"table name with more than three parts: {name!r}")


def metadata_query(name: str, default_database: str | None,
                   default_schema: str | None) -> str:
    """``COUNT(*)`` over ``INFORMATION_SCHEMA.TABLES`` for one schema and table."""
    db, schema, table = split_table_name(name, default_database, default_schema)
    prefix = f"{db}." if db else ""
    where = [f"TABLE_NAME = {sql_text(table)}"]
    if schema:
        where.insert(0, f"TABLE_SCHEMA = {sql_text(schema)}")
    return (f"SELECT COUNT(*) AS CNT FROM {prefix}INFORMATION_SCHEMA.TABLES "
            f"WHERE {' AND '.join(where)}")


def condition_of(exc: AnalysisException) -> str | None:
    return exc.getCondition() if hasattr(exc, "getCondition") else exc.getErrorClass()


def path_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """A table exists at ``path`` when a Spark job committed there (its
    ``_SUCCESS`` marker: one file looked up, nothing listed), when it has a
    manifest with a live batch, or, for data
    written by other tools, when a schema can be read from its files (this
    lists the whole directory). A directory that holds something no schema can
    be read from is not "missing": it raises, since a create would wipe it."""
    try:
        spark.read.text(path.rstrip("/") + "/_SUCCESS").schema
        return True
    except AnalysisException as exc:
        if condition_of(exc) != "PATH_NOT_FOUND":
            raise
    from tidewater.sources.manifest import read_manifest
    found = read_manifest(spark, path)
    if found is not None:
        return bool(found.batches)
    try:
        spark.read.format(fmt).load(path).schema
        return True
    except AnalysisException as exc:
        if condition_of(exc) == "PATH_NOT_FOUND":
            return False
        if condition_of(exc) != "UNABLE_TO_INFER_SCHEMA":
            raise
    # a load that failed its audit leaves nothing but folders of our own
    held = [n for n in list_names(spark, path) or [] if not n.startswith("_tidewater_")]
    if held:
        raise ValueError(f"{path} holds no readable {fmt} table but is not empty: "
                         + ", ".join(held[:5]))
    return False


def table_name(target) -> str:
    """K4 for catalog targets: the quoted name, with the defaults where the
    name leaves parts out (a default database is the catalog)."""
    parts = split_table_name(target.name.replace("`", ""), target.default_database,
                             target.default_schema)
    return ".".join("`" + p + "`" for p in parts if p)


def target_exists(spark: SparkSession, target) -> bool:
    """Dispatch on the target kind (see ``tidewater.plans.spec.Target``)."""
    if target.kind == "path":
        return path_exists(spark, target.name, target.format)
    if target.kind == "table":
        return spark.catalog.tableExists(table_name(target))
    if target.kind in ("jdbc", "connector"):
        q = metadata_query(target.name, target.default_database, target.default_schema)
        if target.kind == "jdbc":
            from tidewater.sources.jdbc import read_jdbc
            opts = {k: v for k, v in target.options.items() if k != "url"}
            df = read_jdbc(spark, target.options["url"], query=q, options=opts)
        else:
            from tidewater.sources.connector import read_query
            df = read_query(spark, target.format, target.options, q)
        return df.first()[0] > 0
    raise ValueError(f"unknown target kind {target.kind!r}")
