"""The table of documents and its log."""

import threading

import pytest

from statuta.sources import documents, log


def version(spark, ids, word):
    return spark.createDataFrame([(f"u{k}", f"{word} {k}") for k in ids], "uri string, xml string")


def rows(df):
    return sorted(map(tuple, df.collect()))


def all_files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_newest_version_counts_and_old_files_stay(spark, tmp_path):
    path = str(tmp_path / "documents")
    assert rows(documents.read(spark, path)) == []
    documents.append(version(spark, range(200), "first"), path, "1")
    before = all_files(tmp_path)
    documents.append(version(spark, range(150, 214), "second"), path, "2")
    documents.append(version(spark, range(150, 214), "again"), path, "2")
    documents.append(version(spark, [], "none"), path, "3")
    after = all_files(tmp_path)
    assert all(after[f] == t for f, t in before.items())
    want = sorted((f"u{k}", f"{'second' if k >= 150 else 'first'} {k}") for k in range(214))
    assert rows(documents.read(spark, path)) == want
    assert rows(documents.read(spark, path, version=0)) == sorted((f"u{k}", f"first {k}") for k in range(200))
    assert documents.compact(spark, path) is not None and documents.compact(spark, path) is None
    assert rows(documents.read(spark, path)) == want
    documents.append(version(spark, [0], "again"), path, "1")  # folded, and remembered
    documents.append(version(spark, [0, 300], "third"), path, "4")
    assert rows(documents.read(spark, path)) == sorted([(u, x) for u, x in want if u != "u0"] + [("u0", "third 0"), ("u300", "third 300")])
    assert documents.clean(spark, path) == 0 and documents.clean(spark, path, older=-60) == 3
    assert len(rows(documents.read(spark, path))) == 215


def test_a_uri_twice_in_a_batch(spark, tmp_path):
    path = str(tmp_path / "documents")
    df = spark.createDataFrame([("a", "1", 5), ("a", "2", 3), ("b", "1", 1), ("b", "2", 1), (None, "x", 0)], "uri string, xml string, at int")
    documents.append(df, path, order=("at",))
    assert sorted(map(tuple, documents.read(spark, path, "uri string, xml string, at int").collect()), key=str) == [("a", "1", 5), ("b", "2", 1), (None, "x", 0)]


def test_a_reader_keeps_what_it_began_with(spark, tmp_path):
    path = str(tmp_path / "documents")
    documents.append(version(spark, range(5), "first"), path)
    began = documents.read(spark, path)
    documents.append(version(spark, range(5), "second"), path)
    documents.compact(spark, path)
    assert rows(began) == [(f"u{k}", f"first {k}") for k in range(5)]
    assert rows(documents.read(spark, path)) == [(f"u{k}", f"second {k}") for k in range(5)]


def test_what_fails_before_its_entry_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "documents")
    documents.append(version(spark, range(3), "first"), path)

    def broken(*_):
        raise OSError("gone")

    monkeypatch.setattr(log, "commit", broken)
    with pytest.raises(OSError):
        documents.append(version(spark, range(3), "second"), path)
    monkeypatch.undo()
    assert rows(documents.read(spark, path)) == [(f"u{k}", f"first {k}") for k in range(3)]


def test_writers_at_once_all_get_a_number(spark, tmp_path):
    path, got = str(tmp_path / "log"), []
    writers = [threading.Thread(target=lambda k=k: got.append(log.commit(spark, path, {"by": k})["version"])) for k in range(8)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert sorted(got) == list(range(8)) and sorted(e["by"] for e in log.entries(spark, path)) == list(range(8))
