"""The unified document schema, and its validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCES = ("pubmed", "google_patents", "uspto", "epo")

AUTHOR = T.StructType([T.StructField("name", T.StringType()), T.StructField("affiliation", T.StringType())])
IDENTIFIER = T.StructType([T.StructField("type", T.StringType()), T.StructField("value", T.StringType())])
DOCUMENT = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("abstract", T.StringType()),
        T.StructField("authors", T.ArrayType(AUTHOR)),
        T.StructField("publication_date", T.DateType()),
        T.StructField("identifiers", T.ArrayType(IDENTIFIER)),
        T.StructField("chemical_entities", T.ArrayType(T.StringType())),
        T.StructField("full_text_url", T.StringType()),
        T.StructField("keywords", T.ArrayType(T.StringType())),
        T.StructField("journal_or_office", T.StringType()),
        T.StructField("metadata", T.VariantType()),
        T.StructField("scraped_at", T.TimestampType()),
    ]
)
LISTS = ("authors", "identifiers", "chemical_entities", "keywords")


def as_document(df: DataFrame, **given: Column) -> DataFrame:
    """df projected onto the schema: columns that aren't given have their defaults."""
    out = []
    for f in DOCUMENT.fields:
        if f.name in given:
            c = given[f.name]
        elif f.name == "metadata":
            c = F.parse_json(F.lit("{}"))
        elif f.name == "scraped_at":
            c = F.current_timestamp()
        elif f.name in LISTS:
            c = F.array()
        else:
            c = F.lit(None)
        out.append((c if f.name == "metadata" else c.cast(f.dataType)).alias(f.name))
    return df.select(*out)


def problems() -> Column:
    """Names of what is wrong with a document; an empty array where nothing is."""
    checks = {
        "source": F.col("source").isNull() | ~F.col("source").isin(*SOURCES),
        "title": F.col("title").isNull(),
        "authors": F.exists("authors", lambda a: a["name"].isNull()),
        "identifiers": F.exists("identifiers", lambda i: i["type"].isNull() | i["value"].isNull()),
        "chemical_entities": F.exists("chemical_entities", lambda x: x.isNull()),
        "keywords": F.exists("keywords", lambda x: x.isNull()),
    }
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in checks.items()]))


def with_defaults(df: DataFrame) -> DataFrame:
    """Missing lists as empty ones, missing metadata as {}."""
    out = df.withColumns({c: F.coalesce(c, F.array().cast(df.schema[c].dataType)) for c in LISTS})
    return out.withColumn("metadata", F.coalesce("metadata", F.parse_json(F.lit("{}"))))


def validate(df: DataFrame, strict: bool = True) -> DataFrame:
    """Documents with defaults filled in; an invalid one raises (strict) or is named in an `_errors` column."""
    out = with_defaults(df)
    if not strict:
        return out.withColumn("_errors", problems())
    bad = problems()
    fine = F.when(F.size(bad) == 0, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("invalid document: "), F.array_join(bad, ", "))).cast("boolean"))
    return out.where(fine)
