"""Registered queries for the record pipeline's operators, with the same in SQL.

The driver's tables hold no bibliographic payloads, so each query derives its
input from a table by an expression that Spark and SQL share, and applies one
operator to all of it.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from papyrine import plans, storage
from papyrine.functions import scalars as S
from papyrine.operators import mappers
from papyrine.schema import as_document, validate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(fmt: str, *cols: Column) -> Column:
    return F.format_string(fmt, *cols)


DAY = "strftime(o_orderdate, '{}')"


@query(
    f"""SELECT o_orderkey, dp, CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-01')
    WHEN 2 THEN strftime(o_orderdate, '%Y-01-01') END AS publication_date FROM (SELECT *, CASE o_orderkey % 6 WHEN 0 THEN {DAY.format('%Y %b %-d')}
    WHEN 1 THEN {DAY.format('%Y %b')} WHEN 2 THEN {DAY.format('%Y')} WHEN 3 THEN '' WHEN 4 THEN 'invalid' ELSE {DAY.format('%Y')} || ' Feb 30' END AS dp FROM orders)"""
)
def medline_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.pmod("o_orderkey", F.lit(6)), F.col("o_orderdate")
    year = F.date_format(d, "yyyy")
    dp = F.when(k == 0, F.date_format(d, "yyyy MMM d")).when(k == 1, F.date_format(d, "yyyy MMM")).when(k == 2, year).when(k == 3, "").when(k == 4, "invalid").otherwise(F.concat(year, F.lit(" Feb 30")))
    return table(spark, sf_dir, "orders").select("o_orderkey", dp.alias("dp")).withColumn("publication_date", S.medline_date(F.col("dp")).cast("string"))


@query(
    f"""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS publication_date FROM orders"""
)
def iso_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.pmod("o_orderkey", F.lit(5)), F.col("o_orderdate")
    s = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyyMMdd")).when(k == 2, F.date_format(d, "yyyy-M")).when(k == 3, "").otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("-02-30")))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.iso_date(s).cast("string").alias("publication_date"))


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN strftime(l_shipdate, '%Y-%m-%d') END AS publication_date FROM lineitem"""
)
def compact_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.pmod("l_linenumber", F.lit(3)), F.col("l_shipdate")
    s = F.when(k == 0, F.date_format(d, "yyyyMMdd")).when(k == 1, F.date_format(d, "yyyyMMd").substr(1, 7)).otherwise(F.concat(F.date_format(d, "yyyy"), F.lit("1301")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", S.compact_date(s).cast("string").alias("publication_date"))


SUBHEADING = ("pharmacology", "Chemistry", "metabolism", "chemical synthesis", "therapeutic use", "toxicity", "ethics", "history")
HEADING_SQL = "p_name || '/' || CASE WHEN p_size % 2 = 0 THEN '*' ELSE '' END || [" + ", ".join(f"'{s}'" for s in SUBHEADING) + "][p_size % 8 + 1]"


def _heading() -> Column:
    pick = F.element_at(F.array(*map(F.lit, SUBHEADING)), (F.pmod("p_size", F.lit(8)) + 1).cast("int"))
    return F.concat(F.col("p_name"), F.lit("/"), F.when(F.pmod("p_size", F.lit(2)) == 0, "*").otherwise(""), pick)


@query(f"""SELECT p_partkey, heading, regexp_matches(lower(replace(heading, '*', '')), '/(pharmacology|chemistry|metabolism|chemical synthesis|therapeutic use|toxicity)') AS chemical FROM (SELECT p_partkey, {HEADING_SQL} AS heading FROM part)""")
def chemical_mesh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", _heading().alias("heading")).withColumn("chemical", S.is_chemical_heading(F.col("heading")))


@query(f"""SELECT p_partkey, CAST(i - 1 AS INT) AS pos, split_part(trim(h[i], '*'), '/', 1) AS entity FROM (SELECT p_partkey, list_filter(['*' || {HEADING_SQL} || '*', p_brand, p_type || '/toxicity', 'Hu*mans/ethics'],
    lambda x: regexp_matches(lower(replace(x, '*', '')), '/(pharmacology|chemistry|metabolism|chemical synthesis|therapeutic use|toxicity)')) AS h FROM part), unnest(range(1, len(h) + 1)) AS t(i)""")
def mesh_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.array(F.concat(F.lit("*"), _heading(), F.lit("*")), F.col("p_brand"), F.concat("p_type", F.lit("/toxicity")), F.lit("Hu*mans/ethics"))
    return table(spark, sf_dir, "part").select("p_partkey", F.posexplode(F.transform(F.filter(h, S.is_chemical_heading), S.chemical_entity)).alias("pos", "entity"))


@query("""SELECT doc_id, array_to_string(list_transform(list_filter(['10.1/' || doc_id || ' [doi]', 'S' || doc_id || ' [pii]', CASE WHEN doc_id % 2 = 0 THEN 'x' || doc_id || '[doi]' ELSE 'none' END],
    lambda a: suffix(a, '[doi]')), lambda a: replace(a, ' [doi]', '')), '|') AS dois FROM documents""")
def doi_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    aid = F.array(F.concat(F.lit("10.1/"), i, F.lit(" [doi]")), F.concat(F.lit("S"), i, F.lit(" [pii]")), F.when(F.pmod("doc_id", F.lit(2)) == 0, F.concat(F.lit("x"), i, F.lit("[doi]"))).otherwise("none"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(F.filter(aid, lambda a: a.endswith("[doi]")), S.doi), "|").alias("dois"))


@query("""SELECT c_custkey, trim(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE split_part(c_name, '#', 1) END || ' ' || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE split_part(c_name, '#', 2) END) AS name FROM customer""")
def inventor_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda n: F.split_part("c_name", F.lit("#"), F.lit(n))
    first, last = F.when(F.pmod("c_custkey", F.lit(3)) != 0, part(1)), F.when(F.pmod("c_custkey", F.lit(5)) == 0, "").otherwise(part(2))
    return table(spark, sf_dir, "customer").select("c_custkey", S.full_name(first, last).alias("name"))


@query("""SELECT p_partkey, array_to_string(list_filter([p_brand, '', CASE WHEN p_size % 2 = 0 THEN p_type END, p_brand], lambda x: x IS NOT NULL AND x <> ''), ',') AS codes FROM part""")
def nonempty_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(F.col("p_brand"), F.lit(""), F.when(F.pmod("p_size", F.lit(2)) == 0, F.col("p_type")), F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.filter(codes, S.present), ",").alias("codes"))


@query("""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'p' || event_id WHEN 1 THEN NULL ELSE 'l' || event_id END AS full_text_url FROM events""")
def url_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, i = F.pmod("event_id", F.lit(3)), F.col("event_id").cast("string")
    pdf = F.when(k == 0, F.concat(F.lit(',"pdf":"p'), i, F.lit('"'))).when(k == 1, ',"pdf":null').otherwise("")
    payload = F.concat(F.lit('{"title":"'), i, F.lit('","link":"l'), i, F.lit('"'), pdf, F.lit("}"))
    return mappers.search_api(table(spark, sf_dir, "events").select(payload.alias("payload"))).select(F.col("title").cast("long").alias("event_id"), "full_text_url")


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS publication_date FROM orders""")
def date_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d = F.pmod("o_orderkey", F.lit(4)), F.date_format("o_orderdate", "yyyy-MM-dd")
    priority = F.when(k == 0, d).when(k == 1, "").when(k == 2, "bad")
    row = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("title"), priority.alias("priority_date"), F.when(k != 3, d).alias("filing_date")))
    return mappers.search_api(table(spark, sf_dir, "orders").select(row.alias("payload"))).select(F.col("title").cast("long").alias("o_orderkey"), F.col("publication_date").cast("string").alias("publication_date"))


@query("""SELECT page_id, split_part(split_part(href, '/patent/', 2), '/', 1) AS patent_number, CASE WHEN href LIKE '/%' THEN 'https://patents.google.com' || href ELSE href END AS full_text_url
    FROM (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '/patent/US' || page_id || '/en' WHEN 1 THEN 'https://x.example/patent/EP' || page_id || '?q=1' ELSE url END AS href FROM pages)""")
def patent_id_from_href(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, i = F.pmod("page_id", F.lit(3)), F.col("page_id").cast("string")
    href = F.when(k == 0, F.concat(F.lit("/patent/US"), i, F.lit("/en"))).when(k == 1, F.concat(F.lit("https://x.example/patent/EP"), i, F.lit("?q=1"))).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", S.patent_id_from_href(href).alias("patent_number"), S.absolute_patent_url(href).alias("full_text_url"))


@query("""SELECT page_id, trim(replace(replace(replace(replace(regexp_extract(html, '<h1>([^<]*)', 1), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')) AS title FROM pages""")
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", S.html_title(F.col("html")).alias("title"))


def _parts_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What XML and HTML payloads are made of; parsing them is Python's work, so all cores have a share."""
    return plans.spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size"))


@query("""SELECT 'p' || p_partkey AS title, trim(p_name) AS abstract, 'EP' || p_partkey || 'A1' AS patent_number, p_brand AS applicant, CASE WHEN p_size <= 29 THEN '2024-02-' || lpad(p_size::VARCHAR, 2, '0') END AS publication_date FROM part""")
def xml_mapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = text(
        "<o:world-patent-data xmlns:o='http://ops.epo.org' xmlns='http://www.epo.org/exchange'><o:search-result><exchange-documents><exchange-document><bibliographic-data>"
        "<publication-reference><document-id><country>EP</country><doc-number>%s</doc-number><kind>A1</kind><date>202402%02d</date></document-id></publication-reference>"
        "<invention-title lang='de'>x</invention-title><invention-title lang='en'>p%s</invention-title><parties><applicants><applicant><applicant-name><name>%s</name></applicant-name></applicant></applicants></parties>"
        "</bibliographic-data><abstract lang='en'><p>%s</p><p>more</p></abstract></exchange-document></exchange-documents></o:search-result></o:world-patent-data>",
        F.col("p_partkey"), F.col("p_size"), F.col("p_partkey"), esc(F.col("p_brand")), esc(F.trim("p_name")),
    )
    docs = mappers.exchange_xml(_parts_spread(spark, sf_dir).select(body.alias("payload")))
    return docs.select("title", "abstract", F.col("identifiers")[0]["value"].alias("patent_number"), F.col("authors")[0]["name"].alias("applicant"), F.col("publication_date").cast("string").alias("publication_date"))


@query("""SELECT 'q' || p_partkey || trim(p_brand) AS title, CASE WHEN p_size % 2 = 0 THEN trim(p_name) END AS abstract, 'EP' || p_partkey || 'A1' AS patent_number, 'https://patents.google.com/patent/EP' || p_partkey || 'A1/en' AS full_text_url FROM part""")
def html_mapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("p_partkey").cast("string")
    snippet = F.when(F.pmod("p_size", F.lit(2)) == 0, F.concat(F.lit('<p class="abstract"> '), F.trim("p_name"), F.lit(" </p>"))).otherwise("")
    page = F.concat(F.lit('<html><div><article class="x result"><h3>q'), i, F.lit(" <i> "), F.trim("p_brand"), F.lit('</i></h3><a href="/other">no</a><a href="/patent/EP'), i, F.lit('A1/en">link</a>'), snippet, F.lit("</article></div><article>none</article></html>"))
    docs = mappers.search_html(_parts_spread(spark, sf_dir).select(page.alias("payload")))
    return docs.select("title", "abstract", F.col("identifiers")[0]["value"].alias("patent_number"), "full_text_url")


@query("""SELECT 'd' || doc_id AS title, lang || ' ' || source AS authors, 'pmid' AS kind, doc_id::VARCHAR AS pmid, '2024-03-01' AS publication_date, 'Drug' AS entity FROM documents""")
def medline_mapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    record = F.concat_ws("\n", F.concat(F.lit("PMID- "), i), F.concat(F.lit("TI  - d"), i), F.concat(F.lit("AU  - "), "lang", F.lit("\n      "), "source"), F.lit("DP  - 2024 Mar"), F.lit("MH  - *Drug/toxicity"), F.lit("MH  - Humans"))
    docs = mappers.medline(mappers.medline_records(table(spark, sf_dir, "documents").select(F.concat(record, F.lit("\n\n")).alias("payload"))))
    return docs.select("title", F.col("authors")[0]["name"].alias("authors"), F.col("identifiers")[0]["type"].alias("kind"), F.col("identifiers")[0]["value"].alias("pmid"), F.col("publication_date").cast("string").alias("publication_date"), F.col("chemical_entities")[0].alias("entity"))


@query("""SELECT 'c' || c_custkey AS title, c_custkey::VARCHAR AS patent_number, c_name || ' ' || c_mktsegment AS inventor, c_mktsegment AS assignee, 'https://patents.google.com/patent/US' || c_custkey AS full_text_url FROM customer WHERE c_custkey % 4 <> 0""")
def patentsview_mapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("c_custkey").cast("string")
    row = F.struct(
        i.alias("patent_id"), F.when(F.pmod("c_custkey", F.lit(4)) != 0, F.concat(F.lit("c"), i)).alias("patent_title"),
        F.array(F.struct(F.lit(None).cast("string").alias("inventor_name_first")), F.struct(F.col("c_name").alias("inventor_name_first"))).alias("nobody"),
        F.array(F.struct(F.col("c_name").alias("inventor_name_first"), F.col("c_mktsegment").alias("inventor_name_last"))).alias("inventors"),
        F.array(F.struct(F.lit("").alias("assignee_organization")), F.struct(F.col("c_mktsegment").alias("assignee_organization"))).alias("assignees"),
    )
    docs = mappers.patentsview(table(spark, sf_dir, "customer").select(F.to_json(row).alias("payload")))
    return docs.select("title", F.col("identifiers")[0]["value"].alias("patent_number"), F.col("authors")[0]["name"].alias("inventor"), F.variant_get("metadata", "$.assignees[0]", "string").alias("assignee"), "full_text_url")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table in the unified schema: title is the first line, abstract the rest."""
    d = table(spark, sf_dir, "documents").withColumn("at", F.instr("text", "\n"))
    title = F.when(F.col("at") > 0, F.substring("text", F.lit(1), F.col("at") - 1)).otherwise(F.col("text"))
    ident = F.array(F.struct(F.lit("pmid").alias("type"), F.col("doc_id").cast("string").alias("value")))
    return as_document(d, source=F.lit("pubmed"), title=title, abstract=F.when(F.col("at") > 0, F.substring("text", F.col("at") + 1, F.lit(1 << 30))), identifiers=ident, keywords=F.array("lang"), journal_or_office=F.col("source"), scraped_at=F.lit("2024-01-01 00:00:00.123456").cast("timestamp"))


def _flat(docs: DataFrame) -> DataFrame:
    return docs.select("source", "title", "abstract", F.col("identifiers")[0]["value"].alias("pmid"), F.array_join("keywords", ",").alias("keywords"), "journal_or_office")


NORMALIZED = """SELECT 'pubmed' AS source, split_part(text, chr(10), 1) AS title, CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) END AS abstract, doc_id::VARCHAR AS pmid, lang AS keywords, source AS journal_or_office FROM documents WHERE split_part(text, chr(10), 1) <> ''"""


@query(NORMALIZED)
def normalized_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(validate(_documents(spark, sf_dir).where(S.present(F.col("title")))))


@query(f"SELECT *, count(*) OVER () AS appended, count(*) OVER () AS counted FROM ({NORMALIZED})")
def doc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appended to JSON Lines files in two writes, counted, and read again."""
    docs = _documents(spark, sf_dir).where(S.present(F.col("title")))
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="papyrine-"))
    path = f"{sc.getCheckpointDir()}/{uuid.uuid4().hex}.jsonl"
    english = F.array_contains("keywords", "en")
    appended = storage.append_documents(path, docs.where(english)) + storage.append_documents(path, docs.where(~english))
    counted = storage.count_documents(spark, path)
    back = storage.read_documents(spark, path).where(F.col("scraped_at") == F.lit("2024-01-01 00:00:00.123456").cast("timestamp"))
    out = _flat(back).withColumns({"appended": F.lit(appended).cast("long"), "counted": F.lit(counted).cast("long")}).checkpoint(eager=True)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return out


@query("""SELECT doc_id::VARCHAR AS pmid, CASE WHEN doc_id % 3 = 0 THEN 'source' WHEN doc_id % 3 = 1 THEN 'title' ELSE '' END AS errors FROM documents""")
def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.pmod("doc_id", F.lit(3))
    d = as_document(table(spark, sf_dir, "documents"), source=F.when(k == 0, F.col("source")).otherwise("epo"), title=F.when(k != 1, F.col("lang")), journal_or_office=F.col("doc_id").cast("string"))
    return validate(d, strict=False).select(F.col("journal_or_office").alias("pmid"), F.array_join("_errors", ",").alias("errors"))


@query("""SELECT doc_id FROM documents WHERE contains(lower(text), 'the th')""")
def text_phrase_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").where(S.has_phrase("The th", F.col("text"))).select("doc_id")


@query("""SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1995-01-01' AND DATE '1996-06-30'""")
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(S.between_dates(F.col("o_orderdate").cast("date"), "1995-01-01", "1996-06-30")).select("o_orderkey")


@query("""SELECT doc_id FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 500) WHERE lang = 'en'""")
def limit_then_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.limit_then_filter(table(spark, sf_dir, "documents").select("doc_id", "lang"), 500, F.col("lang") == "en", [F.col("doc_id")]).select("doc_id")


@query("""SELECT doc_id FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 500""")
def filter_then_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.filter_then_limit(table(spark, sf_dir, "documents").select("doc_id", "lang"), 500, F.col("lang") == "en", [F.col("doc_id")]).select("doc_id")


PARTS_SQL = "SELECT 'pubmed' AS source, doc_id AS seq, lang AS title FROM documents UNION ALL SELECT 'google_patents', page_id, url FROM pages UNION ALL SELECT 'uspto', conv_id * 1000 + turn, role FROM conversations"


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda t, source, seq, title: table(spark, sf_dir, t).select(F.lit(source).alias("source"), seq.alias("seq"), F.col(title).alias("title"))
    return plans.union([part("documents", "pubmed", F.col("doc_id"), "lang"), part("pages", "google_patents", F.col("page_id"), "url"), part("conversations", "uspto", F.col("conv_id") * 1000 + F.col("turn"), "role")])


@query(f"""SELECT source, seq, title FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY seq, title) AS rn FROM ({PARTS_SQL})) WHERE rn <= 100""")
def source_union_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.cap(_parts(spark, sf_dir), 100, [F.col("seq"), F.col("title")])


@query(f"""SELECT source, count(*) AS n FROM ({PARTS_SQL}) GROUP BY ROLLUP (source)""")
def source_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.counts(_parts(spark, sf_dir))


@query("""SELECT count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '\\S')""")
def jsonl_nonblank_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.where(S.non_blank(F.col("line"))).agg(F.count("*").alias("n"))
