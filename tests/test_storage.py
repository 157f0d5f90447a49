from datetime import datetime

import pytest
from pyspark.sql import functions as F

from papyrine import storage
from papyrine.config import Settings, get_settings
from papyrine.logs import setup_logging
from papyrine.schema import DOCUMENT, SOURCES, as_document, validate
from papyrine.streaming import stream_documents


def some(spark, n=3, **given):
    columns = {"source": F.lit("pubmed"), "title": F.concat(F.lit("t"), F.col("id").cast("string"))} | given
    return as_document(spark.range(n), **columns)


def test_defaults(spark):
    d = validate(some(spark, 1)).first()
    assert d.abstract is None and d.authors == [] == d.identifiers and d.chemical_entities == [] == d.keywords and d.metadata.toPython() == {} and d.scraped_at is not None
    assert SOURCES == ("pubmed", "google_patents", "uspto", "epo")


def test_validation(spark):
    with pytest.raises(Exception, match="invalid document"):
        validate(some(spark, 1, title=F.lit(None))).collect()
    with pytest.raises(Exception, match="source"):
        validate(some(spark, 1, source=F.lit("elsewhere"))).collect()
    assert validate(some(spark, 1, title=F.lit(None), source=F.lit("x")), strict=False).first()["_errors"] == ["source", "title"]
    assert validate(some(spark, 1, title=F.lit(""))).count() == 1


def test_roundtrip_and_append(spark, tmp_path):
    path = tmp_path / "deep" / "docs.jsonl"
    when = "2024-05-06 07:08:09.123456"
    docs = some(spark, 2, scraped_at=F.lit(when).cast("timestamp"), metadata=F.parse_json(F.lit('{"a": null, "b": [1]}')))
    assert storage.append_documents(path, docs) == 2 and storage.append_documents(path, some(spark, 1)) == 1
    assert storage.count_documents(spark, path) == 3
    back = storage.read_documents(spark, path).where(F.col("scraped_at") == F.lit(when).cast("timestamp")).orderBy("title").collect()
    assert [d.title for d in back] == ["t0", "t1"] and back[0].metadata.toPython() == {"a": None, "b": [1]} and back[0].scraped_at == datetime(2024, 5, 6, 7, 8, 9, 123456)
    assert '"abstract":null' in "".join(p.read_text() for p in path.glob("part-*")) and [f.name for f in DOCUMENT] == back[0].__fields__
    assert storage.append_documents(tmp_path / "none", some(spark, 0)) == 0
    assert stream_documents(spark, str(path)).isStreaming


def test_bad_lines(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    good = '{"source":"epo","title":"t","other":1}'
    path.write_text("\n".join([good, "", "  \t", " ", "{bad", '{"source":"epo","title":5}', '{"source":"epo","title":"t","authors":null}', '{"source":"epo"}', '{"source":"no","title":"t"}']) + "\n")
    assert storage.count_documents(spark, path) == 6 and storage.count_documents(spark, tmp_path / "missing") == 0
    errors = [r["_errors"] for r in storage.read_documents(spark, path, strict=False).collect()]
    assert errors[0] == [] and "json" in errors[1] and "title type" in errors[2] and errors[3] == ["authors type"] and errors[4] == ["title"] and errors[5] == ["source"]
    with pytest.raises(Exception, match="invalid"):
        storage.read_documents(spark, path).collect()
    path.write_text(good + "\n\n")
    assert storage.read_documents(spark, path).first().keywords == []


@pytest.mark.parametrize(
    "field",
    ['"publication_date":"garbage"', '"publication_date":5', '"keywords":[5]', '"keywords":[null]', '"authors":[1]', '"authors":[{"affiliation":"x"}]', '"authors":[{"name":1}]', '"identifiers":[{"type":"doi"}]', '"metadata":[]', '"scraped_at":"nonsense"', '"scraped_at":null'],
)
def test_wrong_kinds_raise(spark, tmp_path, field):
    path = tmp_path / "x.jsonl"
    path.write_text('{"source":"epo","title":"t",' + field + "}\n")
    with pytest.raises(Exception, match="invalid line: " + field.split('"')[1]):
        storage.read_documents(spark, path).collect()
    assert storage.read_documents(spark, path, strict=False).first()["_errors"][0] == field.split('"')[1] + " type"


def test_right_kinds(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"source":"epo","title":"t","authors":[{"name":"a","x":1}],"publication_date":"2024-02-29","keywords":[],"metadata":{"k":[1]},"scraped_at":"2024-01-01T00:00:00Z"}\n{"source":"epo","title":"u","publication_date":null}\n')
    a, b = storage.read_documents(spark, path).orderBy("title").collect()
    assert a.authors[0].name == "a" and str(a.publication_date) == "2024-02-29" and a.scraped_at == datetime(2024, 1, 1) and a.metadata.toPython() == {"k": [1]}
    assert b.scraped_at is not None and b.publication_date is None and b.keywords == []
    assert storage.exists(spark, path) and not storage.exists(spark, tmp_path / "none")
    assert storage.default_output_path("s3a://b/x/", "epo") == "s3a://b/x/epo.jsonl"


def test_settings(tmp_path, monkeypatch):
    monkeypatch.delenv("NCBI_API_KEY", raising=False)
    assert Settings().ncbi_rate_limit == 3 and Settings(ncbi_api_key="k").ncbi_rate_limit == 10
    env = tmp_path / ".env"
    env.write_text("# c\nNCBI_API_KEY='k'\nOUTPUT_DIR=/x\nUNKNOWN=1\nLOG_LEVEL=DEBUG\n")
    monkeypatch.setenv("LOG_LEVEL", "ERROR")
    s = get_settings(str(env))
    assert s.ncbi_api_key == "k" and str(s.output_dir) == "/x" and s.log_level == "ERROR" and storage.default_output_path(s.output_dir, "epo").name == "epo.jsonl"
    setup_logging("nonsense")
    assert len(setup_logging("DEBUG").handlers) == 1
