import hashlib
import json
import tomllib

from studyloom.sources import readers, sinks
from studyloom.streaming import status


def test_csv_model_and_choices(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('tableName,profiles,note\nT,"P, Q","x, ""y"""\nU,R,\n')
    (tmp_path / "b.csv").write_text("tableName,profiles,note\nV,P,\n")
    assert rows(readers.model_rows(spark, str(tmp_path), "P").select("tableName", "note", "file")) == [("T", 'x, "y"', "a.csv"), ("V", "", "b.csv")]
    (tmp_path / "c.txt").write_text("name\n a \na\n\n")
    assert rows(readers.choice_values(spark, str(tmp_path / "c.txt"))) == [("a",)]


def test_texts_manifest_and_missing(spark, rows, tmp_path):
    (tmp_path / "p 1.ocr.txt").write_text("hello\nyou")
    assert rows(readers.whole_texts(spark, str(tmp_path))) == [("p_20_1.ocr", "hello\nyou")] or rows(readers.whole_texts(spark, str(tmp_path)))[0][1] == "hello\nyou"
    m = readers.manifest(spark, str(tmp_path))
    assert m.first().sha256 == hashlib.sha256(b"hello\nyou").hexdigest()
    assert rows(readers.missing_files(spark, ["x"], m)) == [("x",)]


def test_sinks_round_trip(spark, rows, tmp_path):
    a, b = spark.createDataFrame([(1, "x")], "i long, s string"), spark.createDataFrame([(2, 3)], "i long, n long")
    both = sinks.union_rows([a, b])
    sinks.write_tables({"t": both}, str(tmp_path))
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == rows(both)
    text = sinks.sections_text({"task_b": {"k": 'say "x"', "n": 3, "f": True, "m": {"a": 1}}, "task_a": {}})
    (tmp_path / "p.toml").write_text(text)
    assert readers.sections(str(tmp_path / "p.toml"))["task_b"] == {"k": 'say "x"', "n": 3, "f": True, "m": '{"a": 1}'} and tomllib.loads(text).keys() == {"task_a", "task_b"}


def test_status_stream(spark, rows, tmp_path):
    events = [{"timestamp_utc": f"2024-01-01T00:0{i}:00Z", "run_id": "r", "state": "running" if i < 3 else "done", "message": "", "output_file": ""} for i in range(4)] + [{"timestamp_utc": "bad"}]
    (tmp_path / "s.json").write_text("\n".join(map(json.dumps, events)))
    q = status.latest_states(status.status_stream(spark, str(tmp_path))).writeStream.outputMode("complete").format("memory").queryName("latest").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.sql("SELECT run_id, state FROM latest")) == [("r", "done")]
    q = status.state_counts(status.status_stream(spark, str(tmp_path))).writeStream.outputMode("update").format("memory").queryName("counts").start()
    q.processAllAvailable()
    q.stop()
    assert rows(spark.sql("SELECT run_id, state, n FROM counts")) == [("r", "done", 1), ("r", "running", 3)]
