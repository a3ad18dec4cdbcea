"""Readers, writers and the streaming form over temporary files."""

from __future__ import annotations

import json

import pytest

from derlem.operators import decisions
from derlem.sources import files
from derlem.streaming.decisions import LatestDecisions, late_counts
from tests.conftest import rows


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_jsonl(spark, tmp_path):
    p = put(tmp_path / "a.jsonl", '{"id": "x", "karar": "ok"}\n\n{"id": "y", "siklar": {"A": "b"}}\n{"id": "ya')
    got = files.jsonl(spark, p, files.DECISION, tolerant=True)
    assert rows(got.select("id", "karar")) == [("x", "ok"), ("y", None)]
    assert files.jsonl(spark, str(tmp_path / "none.jsonl"), files.DECISION).count() == 0


def test_logs_and_lists(spark, tmp_path):
    put(tmp_path / "kararlar_1.jsonl", '{"id": "x", "karar": "ok", "zaman": "2"}\n')
    put(tmp_path / "kararlar_2.jsonl", '{"id": "x", "karar": "at", "zaman": "2"}\n')
    log = files.decision_logs(spark, str(tmp_path / "kararlar*.jsonl"))
    assert rows(decisions.latest(log).select("id", "karar")) == [("x", "at")]
    put(tmp_path / "kararlar_3.jsonl", '{"id": "y", "karar": "at", "zaman": "5", "not": "n", "fazla": 1}\n\n{"id": "y", "karar": "ok", "zaman": "5"}\n')
    log = files.decision_logs(spark, str(tmp_path / "kararlar*.jsonl"))
    assert rows(log.filter("id = 'y'").select("karar", "not_", "dosya", "satir")) == [("at", "n", "kararlar_3.jsonl", 0), ("ok", None, "kararlar_3.jsonl", 2)]
    assert rows(decisions.latest(log).filter("id = 'y'").select("karar")) == [("ok",)]  # the later line of equal times
    assert rows(files.unknown_fields(spark, str(tmp_path / "kararlar*.jsonl"))) == [("kararlar_3.jsonl", 0, "fazla")]
    assert files.decision_logs(spark, str(tmp_path / "none*.jsonl")).count() == 0
    p = put(tmp_path / "ids.txt", "a\n\n b \n")
    assert rows(files.id_list(spark, p)) == [("a",), ("b",)]
    assert files.line_count(spark, p) == 2 and files.line_count(spark, str(tmp_path / "no.txt")) == 0


def test_blocks_images_csv_texts(spark, tmp_path):
    array = [{"type": "text", "text": "1. Soru", "page_idx": 3}, {"type": "table", "table_body": "<table/>", "page_idx": 3}]
    put(tmp_path / "cikti/grup/kitap/auto/x_content_list.json", json.dumps(array))
    got = files.block_files(spark, str(tmp_path / "cikti")).collect()
    assert [(r["grup"], r["doc"], r["block_idx"], r["type"], r["page_idx"]) for r in got] == [("grup", "kitap", 0, "text", 3), ("grup", "kitap", 1, "table", 3)]
    p = put(tmp_path / "g.json", json.dumps([{"id": "a", "src": "s", "gorsel": [[4, "image", "x.png"], [5, "table", "y.png"]]}]))
    assert rows(files.image_table(spark, p)) == [("a", "s", 4, "image", "x.png"), ("a", "s", 5, "table", "y.png")]
    p = put(tmp_path / "log.csv", "saniye,sonuc\n1800,ok\n99,hata\n1800,ok\nx,ok\n")
    assert files.run_log_hours(spark, p).first()[0] == 1.0
    assert files.run_log_hours(spark, str(tmp_path / "no.csv")).first()[0] == 0.0
    put(tmp_path / "md/kitap/auto/a.md", "metin")
    assert rows(files.source_texts(spark, str(tmp_path / "md"))) == [("kitap", "metin")]
    assert files.file_sizes(spark, str(tmp_path / "md")).first()["bytes"] == 5
    assert files.file_digests(spark, str(tmp_path / "md")).first()["length"] == 5


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", [], None), ("b", ["x"], "ğ")], "id string, sorunlar array<string>, n string")
    files.write_split(df, str(tmp_path / "ok"), str(tmp_path / "bad"))
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "ok").glob("*.json"))
    assert json.loads(text) == {"id": "a", "n": None}
    assert "ğ" in "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "bad").glob("*.json"))
    files.write_by(df, "id", str(tmp_path / "by"))
    files.write_by(df.filter("id = 'b'"), "id", str(tmp_path / "by"))
    assert {p.name for p in (tmp_path / "by").iterdir() if p.is_dir()} == {"id=a", "id=b"}
    files.write_jsonl(df, str(tmp_path / "log"))
    files.write_jsonl(df, str(tmp_path / "log"), append=True)
    assert spark.read.json(str(tmp_path / "log")).count() == 4
    files.write_list(df, "id", [df.id.desc()], str(tmp_path / "list"))
    assert "".join(p.read_text() for p in sorted((tmp_path / "list").glob("part*"))) == "b\na\n"
    files.write_csv(df, ["id", "n"], str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["id", "n"]
    assert all(p.read_bytes().startswith(b"\xef\xbb\xbfid,n") for p in (tmp_path / "csv").glob("*.csv"))


def test_waiting_for_ids(spark):
    tables = [spark.createDataFrame([(i,) for i in ids], "id string") for ids in ("a", "ab")]
    seen = []

    def read():
        seen.append(1)
        return tables[min(len(seen), 2) - 1]

    wanted = spark.createDataFrame([("a",), ("b",)], "id string")
    assert files.wait_for_ids(read, wanted, pause=0).count() == 2 and len(seen) == 2
    with pytest.raises(LookupError, match="c"):
        files.wait_for_ids(read, spark.createDataFrame([("c",)], "id string"), tries=2, pause=0)


def test_request_batch(spark):
    got = files.request_batch(spark, '[{"id": "x", "cevap": "A", "gerekce": "g"}, {"id": "y", "cevap": "B", "soru": "s"}]')
    assert rows(got.select("id", "cevap", "soru")) == [("x", "A", None), ("y", "B", "s")]


def test_stream_of_decisions_equals_batch(spark, data, tmp_path):
    from derlem.sources.tables import table

    log = table(spark, data, "decision").select("kayit_no", "id", "karar", "zaman")
    log.repartition(3).write.parquet(str(tmp_path / "log"))
    schema = log.schema.simpleString()[7:-1].replace(":", " ")
    sink = LatestDecisions(spark, str(tmp_path / "out"), schema)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))
    sink.follow(stream, str(tmp_path / "cp")).awaitTermination(120)
    assert rows(sink.current()) == rows(decisions.latest(log).select(*sink.current().columns))


def test_a_restart_goes_on_from_the_last_complete_version(spark, tmp_path):
    schema = "kayit_no long, id string, karar string, zaman string"
    batch = lambda *r: spark.createDataFrame(r, schema)
    LatestDecisions(spark, str(tmp_path), schema).merge(batch((1, "a", "ok", "1"), (2, "b", "ok", "1")), 0)
    (tmp_path / "v=00000001").mkdir()  # a version that was never finished
    again = LatestDecisions(spark, str(tmp_path), schema)
    again.merge(batch((3, "c", "at", "2"), (4, "a", "at", "2")), 1)
    want = [("a", "at"), ("b", "ok"), ("c", "at")]
    assert rows(again.current().select("id", "karar")) == want and again.versions() == [0, 1]
    again.merge(batch((3, "c", "at", "2"), (4, "a", "at", "2")), 1)  # replayed
    assert rows(again.current().select("id", "karar")) == want
    again.merge(batch((5, "b", "at", "3")), 2)
    assert again.versions() == [1, 2] and rows(again.current().select("id", "karar"))[1] == ("b", "at")


def test_late_counts(spark, data, tmp_path):
    from pyspark.sql import functions as F

    from derlem.sources.tables import table

    rec = table(spark, data, "sft_record").select(F.col("islenme").cast("timestamp").alias("islenme"))
    rec.write.parquet(str(tmp_path / "in"))
    q = late_counts(spark.readStream.schema(rec.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("gunler").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("gunler").agg(F.sum("n")).first()[0] == rec.filter("islenme is not null").count()
