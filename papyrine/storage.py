"""JSON Lines storage: a directory of part files for each target."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from papyrine.functions.scalars import non_blank
from papyrine.schema import DOCUMENT, validate

#: Six digits of a second always, and the zone; the default would cut to milliseconds.
TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def default_output_path(output_dir: str | Path, source: str) -> str | Path:
    """The source's target below a local folder, or below a remote one (a text with ://)."""
    return f"{str(output_dir).rstrip('/')}/{source}.jsonl" if "://" in str(output_dir) else Path(output_dir) / f"{source}.jsonl"


def exists(spark: SparkSession, path: str | Path) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def append_documents(path: str | Path, docs: DataFrame) -> int:
    """Append documents as JSON lines, nulls and empty lists included; returns how many. The count comes from the write itself."""
    seen = Observation("appended")
    docs.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").option("ignoreNullFields", "false").option("timestampFormat", TIMESTAMP).json(str(path))
    return int(seen.get["n"])


def _kind(v: Column, path: str | None = None) -> Column:
    """The JSON kind of a value; null where there is no such key."""
    return F.schema_of_variant(v if path is None else F.try_variant_get(v, path, "variant"))


def _wrong_kinds(v: Column) -> list[Column]:
    """Names of fields whose JSON value has the wrong kind, elements of lists included."""

    def text(x: Column, path: str) -> Column:
        return F.coalesce(_kind(x, path), F.lit("VOID")) != "STRING"

    def other(x: Column, path: str) -> Column:
        return ~F.coalesce(_kind(x, path), F.lit("VOID")).isin("STRING", "VOID")

    def sure(wrong: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda x: F.coalesce(wrong(x), F.lit(True))

    elements = {
        "authors": lambda x: ~_kind(x).startswith("OBJECT") | text(x, "$.name") | other(x, "$.affiliation"),
        "identifiers": lambda x: ~_kind(x).startswith("OBJECT") | text(x, "$.type") | text(x, "$.value"),
        "chemical_entities": lambda x: _kind(x) != "STRING",
        "keywords": lambda x: _kind(x) != "STRING",
    }
    out = [F.when(v.isNull() | ~_kind(v).startswith("OBJECT"), F.lit("json"))]
    for f in DOCUMENT.fields:
        kind = _kind(v, f"$.{f.name}")
        if f.name in elements:
            items = F.try_variant_get(v, f"$.{f.name}", "array<variant>")
            bad = ~kind.startswith("ARRAY") | F.exists(items, sure(elements[f.name]))
        elif f.name == "metadata":
            bad = ~kind.startswith("OBJECT")
        elif f.name == "publication_date":
            day = F.try_variant_get(v, "$.publication_date", "string")
            bad = (kind != "VOID") & ((kind != "STRING") | ~day.rlike(r"^\d{4}-\d\d-\d\d") | F.col("d.publication_date").isNull())
        elif f.name == "scraped_at":
            bad = (kind != "STRING") | F.col("scraped").isNull()
        else:
            bad = ~kind.isin("STRING", "VOID")
        out.append(F.when(kind.isNotNull() & F.coalesce(bad, F.lit(True)), F.lit(f"{f.name} type")))
    return out


def read_documents(spark: SparkSession, path: str | Path, strict: bool = True) -> DataFrame:
    """Validated documents; blank lines are skipped. Bad lines raise (strict) or are marked in `_errors`.

    Lines are parsed as VARIANT beside the schema: once typed, a number in a text
    field would look like text, a null list like a missing one, and a bad date like
    none.  Without the key, scraped_at is the time of the query; unknown keys are
    left out.
    """
    lines = spark.read.text(str(path)).where(non_blank(F.col("value")))
    typed = F.from_json("value", DOCUMENT, {"mode": "PERMISSIVE", "timestampFormat": TIMESTAMP})
    once = lines.select(F.inline(F.array(F.struct(F.try_parse_json("value").alias("v"), typed.alias("d")))))  # a generator, else each field would parse the line again
    once = once.withColumn("scraped", F.expr("try_cast(try_variant_get(v, '$.scraped_at', 'string') AS timestamp)"))
    when = F.when(_kind(F.col("v"), "$.scraped_at").isNull(), F.current_timestamp()).otherwise(F.col("scraped"))
    fields = [when.alias(f.name) if f.name == "scraped_at" else F.col(f"d.{f.name}").alias(f.name) for f in DOCUMENT.fields]
    parsed = once.select(*fields, F.array_compact(F.array(*_wrong_kinds(F.col("v")))).alias("_wrong"))
    if strict:
        fine = F.when(F.size("_wrong") == 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("invalid line: "), F.array_join("_wrong", ", "))).cast("boolean"))
        return validate(parsed.where(fine).drop("_wrong"))
    checked = validate(parsed, strict=False)
    return checked.withColumn("_errors", F.array_union("_wrong", "_errors")).drop("_wrong")


def count_documents(spark: SparkSession, path: str | Path) -> int:
    """Lines that aren't blank, parsed or not; 0 where there is no such path."""
    try:
        return spark.read.text(str(path)).where(non_blank(F.col("value"))).count()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise
