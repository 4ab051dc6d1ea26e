"""Control data: environment, ingest and connector documents."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tierflow import errors

# Field names of the three documents. Maps stay maps instead of
# being inferred as structs, so any column or option name is accepted.
ENVIRONMENT = (
    "storage_account_name string, storage_account_access_key string, "
    "silver_format string, gold_format string, root string"
)
INGEST = (
    "source struct<db: string, table: string, columns: map<string, string>, delta_column: string, "
    "calendar: struct<start_date: string, end_date: string>, connector: string>, "
    "sink struct<source: struct<format: string, options: map<string, string>>>"
)
CONNECTOR = "format string, options map<string, string>"


@dataclass(frozen=True)
class Spec:
    """One ingest: what to read, how, and where its tiers live."""

    ingest: str
    db: str
    table: str
    columns: dict[str, str]
    delta: str | None
    start_date: str | None
    end_date: str | None
    bronze_root: str
    silver_root: str
    gold_root: str
    silver_format: str = "parquet"
    gold_format: str = "parquet"
    bronze_format: str = "parquet"
    bronze_options: dict[str, str] = field(default_factory=dict)
    source_format: str = "jdbc"
    source_options: dict[str, str] = field(default_factory=dict, repr=False)

    @property
    def delta_is_time(self) -> bool:
        """Whether the delta column is declared as dates or times, or not declared."""
        kind = self.columns.get(self.delta, "timestamp")
        return kind.lower().startswith(("date", "timestamp"))

    @property
    def bronze_path(self) -> str:
        return f"{self.bronze_root}/{self.table}"

    @property
    def silver_path(self) -> str:
        return f"{self.silver_root}/{self.table}"

    @property
    def checkpoint_path(self) -> str:
        return f"{self.silver_root}/_checkpoints/{self.table}"

    @property
    def schema_path(self) -> str:
        return f"{self.silver_root}/_schemas/{self.table}"

    @property
    def index_path(self) -> str:
        return f"{self.silver_root}/_index/{self.table}"

    @property
    def marks_path(self) -> str:
        return f"{self.bronze_root}/_marks"

    def gold_path(self, name: str) -> str:
        return f"{self.gold_root}/{name}"


def tier_root(env: Row, tier: str) -> str:
    """Root folder of a tier: under `root` when set, else a container of the
    storage account."""
    if env["root"]:
        return f"{env['root'].rstrip('/')}/{tier}"
    return f"abfss://{tier}@{env['storage_account_name']}.dfs.core.windows.net"


def load_spec(spark: SparkSession, ingest: str, environment: str, ingests: str, connectors: str) -> Spec:
    """Spec of one ingest from the environment file, the folder of ingest
    documents and the folder of connector documents."""
    env = _document(spark, environment, ENVIRONMENT, errors.ENVIRONMENT)
    # A map loses its order on the way to Python, its entries do not.
    doc = _document(spark, f"{ingests.rstrip('/')}/{ingest}.json", INGEST, errors.INGEST, _columns=F.map_entries("source.columns"))
    source = doc["source"]
    connector = _document(spark, f"{connectors.rstrip('/')}/{source['connector']}", CONNECTOR, errors.CONNECTOR)
    calendar = source["calendar"] or Row(start_date=None, end_date=None)
    sink = (doc["sink"] and doc["sink"]["source"]) or Row(format=None, options=None)
    return Spec(
        ingest=ingest,
        db=source["db"],
        table=source["table"],
        columns=dict(doc["_columns"]),
        delta=source["delta_column"],
        start_date=calendar["start_date"],
        end_date=calendar["end_date"],
        bronze_root=tier_root(env, "bronze"),
        silver_root=tier_root(env, "silver"),
        gold_root=tier_root(env, "gold"),
        silver_format=env["silver_format"] or "parquet",
        gold_format=env["gold_format"] or "parquet",
        bronze_format=(sink["format"] or "parquet").replace("cloudFiles", "parquet"),
        bronze_options=sink["options"] or {},
        source_format=connector["format"],
        source_options=connector["options"] or {},
    )


def control_table(spark: SparkSession, environment: str, ingests: str, connectors: str) -> DataFrame:
    """All ingests of a folder of documents, one row each.

    What is read (`db`, `table`, `columns`, `delta`, `start_date`, `end_date`), how (`source_format`,
    `source_options`, `bronze_format`, `bronze_options`, the tiers' formats) and where it lies
    (`bronze_root` to `marks_path`). Documents are read by tasks and joined by the connector's file name;
    an ingest whose connector has no document has no `source_format`.
    """
    env = _document(spark, environment, ENVIRONMENT, errors.ENVIRONMENT)
    docs = _documents(spark, ingests, INGEST).withColumn("ingest", F.regexp_extract("_file", r"^(.*)\.json$", 1))
    ways = _documents(spark, connectors, CONNECTOR).select(F.col("_file").alias("connector"), F.col("format").alias("source_format"), F.col("options").alias("source_options"))
    roots = {tier: tier_root(env, tier) for tier in ("bronze", "silver", "gold")}
    table, none = F.col("source.table"), F.create_map().cast("map<string,string>")

    def under(*parts: str | Column) -> Column:
        return F.concat(*(F.lit(x) if isinstance(x, str) else x for x in parts))

    found = docs.join(ways, docs["source.connector"] == ways["connector"], "left")
    return found.select(
        "ingest",
        F.col("source.db").alias("db"),
        table.alias("table"),
        F.col("source.columns").alias("columns"),
        F.col("source.delta_column").alias("delta"),
        F.col("source.calendar.start_date").alias("start_date"),
        F.col("source.calendar.end_date").alias("end_date"),
        "source_format",
        F.coalesce("source_options", none).alias("source_options"),
        F.replace(F.coalesce("sink.source.format", F.lit("parquet")), F.lit("cloudFiles"), F.lit("parquet")).alias("bronze_format"),
        F.coalesce("sink.source.options", none).alias("bronze_options"),
        F.lit(env["silver_format"] or "parquet").alias("silver_format"),
        F.lit(env["gold_format"] or "parquet").alias("gold_format"),
        *(F.lit(root).alias(f"{tier}_root") for tier, root in roots.items()),
        under(roots["bronze"], "/", table).alias("bronze_path"),
        under(roots["silver"], "/", table).alias("silver_path"),
        under(roots["silver"], "/_checkpoints/", table).alias("checkpoint_path"),
        under(roots["silver"], "/_schemas/", table).alias("schema_path"),
        under(roots["silver"], "/_index/", table).alias("index_path"),
        under(roots["bronze"], "/_marks").alias("marks_path"),
    )


def load_specs(spark: SparkSession, environment: str, ingests: str, connectors: str) -> dict[str, Spec]:
    """The specs of all ingests of a folder, by name."""
    given = Spec.__dataclass_fields__
    specs = {}
    # Entries keep the order of the document.
    rows = control_table(spark, environment, ingests, connectors).withColumn("columns", F.map_entries("columns"))
    for row in rows.collect():
        if row["source_format"] is None:
            raise RuntimeError(errors.CONNECTOR.format(cause=f"ingest {row['ingest']} names none that is there"))
        values = row.asDict() | {"columns": dict(row["columns"])}
        specs[row["ingest"]] = Spec(**{k: v for k, v in values.items() if k in given})
    return specs


def _documents(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Every document of a folder with its file name; one that does not parse fails the read."""
    docs = spark.read.schema(schema).json(folder, multiLine=True, mode="FAILFAST")
    # File names come percent-encoded, as in a path: a plus sign is one.
    return docs.withColumn("_file", F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))))


def _document(spark: SparkSession, path: str, schema: str, message: str, **added: Column) -> Row:
    try:
        return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST").withColumns(added).collect()[0]
    except Exception as e:
        raise RuntimeError(message.format(cause=e)) from e
