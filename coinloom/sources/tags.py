"""Entity tags from CSV and XML files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinloom.operators.upsert import first_of_each

_BUNDLED = "address string, entity_name string, category string, confidence string, reference string"
_ENTRY = (
    "lastName string, firstName string, remarks string, programList struct<program:array<string>>, "
    "idList struct<id:array<struct<idType:string,idNumber:string>>>"
)


def read_bundled_csv(spark: SparkSession, path: str, source: str = "builtin") -> DataFrame:
    """A CSV with a header; lines that start with # are comments; an empty confidence means 0.7."""
    rows = spark.read.csv(path, header=True, comment="#", schema=_BUNDLED)
    return rows.select(
        F.trim("address").alias("address"), F.lit(source).alias("source"), "entity_name", "category",
        F.coalesce(F.nullif(F.trim("confidence"), F.lit("")).try_cast("double"), F.lit(0.7)).alias("confidence"), "reference",
    )


def read_generic_csv(
    spark: SparkSession, path: str, source: str, category: str = "other", confidence: float = 0.7
) -> DataFrame:
    """address[, name[, category]]; the first line of a file is a header if its first cell says so.

    A name defaults to the source, a category to `category`.
    """
    rows = spark.read.option("comment", "#").csv(path, schema="c0 string, c1 string, c2 string").select(
        "*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    first = rows.groupBy("file").agg(F.min("at").alias("at")).withColumn("_first", F.lit(True))
    heading = F.lower(F.trim("c0")).isin("address", "addr")
    cell = lambda c: F.nullif(F.trim(c), F.lit(""))
    return (
        rows.join(first, ["file", "at"], "left")
        .withColumn("_head", F.col("_first") & heading)
        .filter(~F.coalesce("_head", F.lit(False)) & cell("c0").isNotNull())
        .select(
            cell("c0").alias("address"), F.lit(source).alias("source"), F.coalesce(cell("c1"), F.lit(source)).alias("entity_name"),
            F.coalesce(cell("c2"), F.lit(category)).alias("category"), F.lit(confidence).alias("confidence"),
            F.concat(F.lit("import:"), F.lit(source)).alias("reference"),
        )
    )


def read_sanctions_xml(spark: SparkSession, path: str) -> DataFrame:
    """`address, currency, name, program`: one row per address, the first mention in document order.

    Addresses come from the structured ids, then from the remarks of an entry.
    """
    rows = spark.read.format("xml").option("rowTag", "sdnEntry").schema(_ENTRY).load(path)
    return sanctioned_addresses(rows.withColumn("at", F.monotonically_increasing_id()))


def sanctioned_addresses(entries: DataFrame) -> DataFrame:
    """Addresses of parsed entries; `at` orders the entries."""
    # How the list writes an address in its remarks, and the name of an entry without one.
    pattern = r"Digital Currency Address\s*-\s*(\w+)\s+([A-Za-z0-9]+)"
    ids = F.transform(
        F.filter("idList.id", lambda i: F.contains(i["idType"], F.lit("Digital Currency Address")) & i["idNumber"].isNotNull()),
        lambda i: F.struct(F.trim(i["idNumber"]).alias("address"), F.trim(F.substring_index(i["idType"], "-", -1)).alias("currency")),
    )
    said = F.coalesce("remarks", F.lit(""))
    free = F.transform(
        F.arrays_zip(F.regexp_extract_all(said, F.lit(pattern), F.lit(2)).alias("a"), F.regexp_extract_all(said, F.lit(pattern), F.lit(1)).alias("c")),
        lambda z: F.struct(z["a"].alias("address"), z["c"].alias("currency")),
    )
    none = F.array().cast("array<struct<address:string,currency:string>>")
    programs = F.array_join(F.array_sort(F.array_distinct(F.coalesce("programList.program", F.array().cast("array<string>")))), ", ")
    name = F.coalesce(F.nullif(F.concat_ws(" ", "lastName", "firstName"), F.lit("")), F.lit("OFAC SDN"))
    each = entries.select(
        "at", name.alias("name"), programs.alias("program"), F.posexplode(F.concat(F.coalesce(ids, none), F.coalesce(free, none))).alias("nth", "x")
    ).select("at", "nth", "x.address", "x.currency", "name", "program")
    return first_of_each(each, ["address"], ["at", "nth"]).select("address", "currency", "name", "program")


def sanction_tags(found: DataFrame, all_currencies: bool = False) -> DataFrame:
    kept = found if all_currencies else found.filter(F.upper("currency") == "XBT")
    return kept.select(
        "address", F.lit("OFAC").alias("source"),
        F.concat("name", F.when(F.col("program") != "", F.concat(F.lit(" ["), F.col("program"), F.lit("]"))).otherwise("")).alias("entity_name"),
        F.lit("sanctioned").alias("category"), F.lit(1.0).alias("confidence"),
        F.concat(F.lit("SDN list, "), F.col("currency")).alias("reference"),
    )


def list_tags(
    tags: DataFrame, source: str | None = None, category: str | None = None, search: str | None = None, limit: int = 50
) -> DataFrame:
    """Tags by source, category, and a text in address or name (any case), in order of category and name."""
    rows = tags
    if source is not None:
        rows = rows.filter(F.col("source") == source)
    if category is not None:
        rows = rows.filter(F.col("category") == category)
    if search is not None:
        like = "%" + search.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_") + "%"
        rows = rows.filter(F.col("address").ilike(like) | F.col("entity_name").ilike(like))
    return rows.orderBy("category", "entity_name", "address", "source").limit(limit)


def tag_counts(tags: DataFrame) -> DataFrame:
    return tags.groupBy("source", "category").agg(F.count("*").alias("n"), F.count_distinct("address").alias("addresses"))


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    from coinloom.sources.schemas import PRICES

    return spark.read.csv(path, header=True, comment="#", schema=PRICES)
