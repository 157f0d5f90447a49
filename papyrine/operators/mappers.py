"""Mappers: raw payload rows to unified documents.  A record without a title is dropped."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papyrine.functions import scalars as S
from papyrine.operators.markup import html_results, xml_documents
from papyrine.schema import as_document


def _json(c: Column) -> Column:
    return F.parse_json(F.to_json(c, {"ignoreNullFields": "false"}))


def _identifier(kind: str, value: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), value.alias("value"))


def _author(name: Column) -> Column:
    return F.struct(name.alias("name"), F.lit(None).cast("string").alias("affiliation"))


def _patent_number(value: Column) -> Column:
    return F.when(S.present(value), F.array(_identifier("patent_number", value))).otherwise(F.array().cast("array<struct<type:string,value:string>>"))


def medline_records(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each record of tagged-text payloads; a blank line ends a record."""
    text = F.regexp_replace(F.col(payload), r"\r\n?", "\n")
    return df.select(F.explode(F.split(text, r"\n\s*\n")).alias("record")).where(S.non_blank(F.col("record")))


def medline(df: DataFrame, record: str = "record") -> DataFrame:
    """Tagged-text records to documents."""
    unfolded = F.regexp_replace(F.col(record), r"\n {6}", " ")
    df = df.select(F.split(unfolded, "\n").alias("lines"))

    def all_of(tag: str) -> Column:
        lead = f"{tag:<4}- "
        return F.transform(F.filter("lines", lambda x: x.startswith(lead)), lambda x: F.rtrim(F.substring(x, 7, 1 << 30)))

    def one_of(tag: str) -> Column:
        return F.when(F.size(all_of(tag)) > 0, F.array_join(all_of(tag), " "))

    df = df.select(*[one_of(t).alias(t) for t in ("PMID", "TI", "AB", "DP", "JT")], *[all_of(t).alias(t) for t in ("AU", "AID", "MH", "OT", "PT", "LA")]).where(S.present(F.col("TI")))
    pmid = F.col("PMID")
    dois = F.transform(F.filter("AID", lambda a: a.endswith("[doi]")), lambda a: _identifier("doi", S.doi(a)))
    return as_document(
        df,
        source=F.lit("pubmed"),
        title=F.col("TI"),
        abstract=F.col("AB"),
        authors=F.transform("AU", _author),
        publication_date=S.medline_date(F.col("DP")),
        identifiers=F.when(S.present(pmid), F.concat(F.array(_identifier("pmid", pmid)), dois)).otherwise(dois),
        chemical_entities=F.transform(F.filter("MH", S.is_chemical_heading), S.chemical_entity),
        keywords=F.col("OT"),
        journal_or_office=F.col("JT"),
        full_text_url=F.when(S.present(pmid), F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/"))),
        metadata=_json(F.struct(F.col("MH").alias("mesh_headings"), F.col("PT").alias("publication_type"), F.col("LA").alias("language"))),
    )


PATENT = "struct<patent_id:string,patent_title:string,patent_abstract:string,patent_date:string,inventors:array<struct<inventor_name_first:string,inventor_name_last:string>>,assignees:array<struct<assignee_organization:string>>,cpc_current:array<struct<cpc_group_id:string>>>"


def patentsview(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Patent JSON objects to documents; null lists count as empty, null name parts as ''."""
    df = df.select(F.from_json(payload, PATENT).alias("p")).select("p.*").where(S.present(F.col("patent_title")))

    def kept(column: str, field: str) -> Column:
        values = F.transform(F.coalesce(column, F.array()), lambda x: x[field])
        return F.filter(values, S.present)

    named = F.filter(F.coalesce("inventors", F.array()), lambda i: S.present(i["inventor_name_first"]) | S.present(i["inventor_name_last"]))
    number = F.col("patent_id")
    return as_document(
        df,
        source=F.lit("uspto"),
        title=F.col("patent_title"),
        abstract=F.col("patent_abstract"),
        authors=F.transform(named, lambda i: _author(S.full_name(i["inventor_name_first"], i["inventor_name_last"]))),
        publication_date=S.iso_date(F.col("patent_date")),
        identifiers=_patent_number(number),
        full_text_url=F.when(S.present(number), F.concat(F.lit("https://patents.google.com/patent/US"), number)),
        journal_or_office=F.lit("USPTO"),
        metadata=_json(F.struct(kept("cpc_current", "cpc_group_id").alias("cpc_codes"), kept("assignees", "assignee_organization").alias("assignees"))),
    )


def search_api(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Search-API result objects to documents.  A key that is null differs from one that is missing, hence VARIANT."""
    df = df.select(F.parse_json(payload).alias("v"))

    def field(name: str) -> Column:
        return F.variant_get("v", f"$.{name}", "string")

    def has(name: str) -> Column:
        return F.variant_get("v", f"$.{name}", "variant").isNotNull()

    day = F.coalesce(F.nullif(field("priority_date"), F.lit("")), field("filing_date"))
    return as_document(
        df.where(S.present(field("title"))),
        source=F.lit("google_patents"),
        title=field("title"),
        abstract=field("snippet"),
        authors=F.when(S.present(field("inventor")), F.array(_author(field("inventor")))).otherwise(F.array().cast("array<struct<name:string,affiliation:string>>")),
        publication_date=S.iso_date(day),
        identifiers=_patent_number(field("patent_id")),
        full_text_url=F.when(has("pdf"), field("pdf")).otherwise(field("link")),
        journal_or_office=F.when(has("assignee"), field("assignee")).otherwise(F.lit("")),
        metadata=_json(F.struct(field("grant_date").alias("grant_date"), field("thumbnail").alias("thumbnail"))),
    )


XML_ROW = "array<struct<title:string,abstract:string,number:string,authors:array<string>,day:string,ipc:array<string>>>"
HTML_ROW = "array<struct<title:string,href:string,abstract:string>>"


def exchange_xml(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Patent-exchange XML responses to documents; a malformed response gives none."""
    parse = F.pandas_udf(lambda s: pd.Series([xml_documents(x) for x in s]), XML_ROW)
    df = df.select(F.inline(parse(F.col(payload)))).where(S.present(F.col("title")))
    return as_document(
        df,
        source=F.lit("epo"),
        title=F.col("title"),
        abstract=F.col("abstract"),
        authors=F.transform("authors", _author),
        publication_date=S.compact_date(F.col("day")),
        identifiers=_patent_number(F.col("number")),
        journal_or_office=F.lit("EPO"),
        metadata=_json(F.struct(F.col("ipc").alias("ipc_codes"))),
    )


def search_html(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Search-result pages to documents."""
    parse = F.pandas_udf(lambda s: pd.Series([html_results(x) for x in s]), HTML_ROW)
    df = df.select(F.inline(parse(F.col(payload)))).where(S.present(F.col("title")))
    return as_document(
        df,
        source=F.lit("google_patents"),
        title=F.col("title"),
        abstract=F.col("abstract"),
        identifiers=_patent_number(S.patent_id_from_href(F.col("href"))),
        full_text_url=S.absolute_patent_url(F.col("href")),
        journal_or_office=F.lit("Google Patents"),
    )
