"""The pipeline's stages on odd rows, empty tables and clashing columns, and one after the other against plain versions."""

import brute
import pytest

from statuta.llm import mixing, quality_cnn

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars int, _score string, _key string, n_pieces string"
ODD = [
    (1, None, "en", "a", 0, "x", "y", None),
    (1, None, "en", "a", 0, "x", "y", None),
    (2, "", None, "a", None, None, "y", "z"),
    (None, "  \n", "en", None, 3, "x", None, "z"),
    (None, "one two three four five six seven", "en", None, 3, "x", "y", "z"),
    (4, "one two three four five six seven", "en", "b", 3, "x", "y", "z"),
    (4, "one two three four five six seven", "en", "b", 3, "x", "y", "z"),
    (5, "ONE two three four five six\tseven", "en", "b", 3, "x", "y", "z"),
    (6, "word " * 40_000, "en", "b", 200_000, "x", "y", "z"),
    (7, "日本語" * 4000, "ja", "c", 12_000, "x", "y", "z"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, COLUMNS).repartition(3).cache()


@pytest.fixture(scope="module")
def stages():
    import corpus_pipeline

    return dict(corpus_pipeline.STAGES)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_quality(spark, odd, stages):
    model = quality_cnn.train(odd, spark.read.parquet(f"{SF}/labels.parquet"))
    score = {t: quality_cnn.score_texts(model, [(t or "").encode()])[0] for _, t, *_ in ODD}
    got = stages["quality"](spark, odd, SF)
    assert got.columns == odd.columns
    assert rows(got) == sorted([r for r in ODD if score[r[1]] >= 0.3], key=str)


def test_quality_without_labels(spark, odd, stages, tmp_path):
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert stages["quality"](spark, odd, str(tmp_path)).count() == len(ODD)


def test_near_duplicates(spark, odd, stages):
    got = rows(stages["near_duplicates"](spark, odd, SF))
    gone = [ODD[4], ODD[6], ODD[7]]  # of the four like texts the smallest id stays, once
    want = list(ODD)
    for r in gone:
        want.remove(r)
    assert got == sorted(want, key=str)


def test_mixture(spark, odd, stages):
    got, copies = rows(stages["mixture"](spark, odd, SF)), mixing.mix(odd).collect()
    assert len(got) == sum(r.copies for r in copies) and set(got) <= set(ODD)
    for r in set(ODD):
        assert got.count(r) <= 3 * ODD.count(r)


def test_pieces(spark, odd, stages):
    got = stages["pieces"](spark, odd, SF).collect()
    assert len(got) == len(ODD) and all(r.lossless for r in got)
    assert sorted(r.n_pieces == 0 for r in got) == sorted(not r[1] for r in ODD)
    assert got == stages["pieces"](spark, odd, SF).collect()


@pytest.mark.parametrize("name", ["quality", "near_duplicates", "mixture", "pieces"])
def test_empty_table(spark, odd, stages, name):
    got = stages[name](spark, odd.limit(0), SF)
    assert got.count() == 0 and (name == "pieces" or got.columns == odd.columns)


def test_run(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    model = quality_cnn.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    kept = [r for r in docs if quality_cnn.score_texts(model, [(r.text or "").encode()])[0] >= 0.3]
    top = brute.jaccard_components([(r.doc_id, r.text) for r in kept], 5, 80, 100)[1]
    one = [r for r in kept if top[r.doc_id] == r.doc_id]
    copies = {r.doc_id: r.copies for r in mixing.mix(spark.createDataFrame(one)).collect()}
    got = P.run(spark, SF).groupBy("doc_id").count().collect()
    assert {r[0]: r[1] for r in got} == {k: n for k, n in copies.items() if n}
