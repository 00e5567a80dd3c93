"""The pipeline on a small corpus with planted cases."""

import random

import corpus_pipeline as C


def planted():
    rng = random.Random(9)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "se") for b in ("ta", "ne", "po", "vi", "dum", "gras")]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + "."
    docs = [(i, text(rng.randrange(60, 200))) for i in range(240)]
    toxic = {i for i in range(240) if i % 5 == 0}
    docs = [(i, t.replace(" ", " you idiot moron ", 2) if i in toxic else t) for i, t in docs]
    passage = text(30)
    docs += [(300, docs[1][1]), (301, docs[2][1] + " tail"), (302, text(80) + " " + passage + " " + text(80)), (303, text(90) + " password=abcdef12345 end"), (304, None), (305, "")]
    return docs, toxic, passage


def test_stages(spark, tmp_path):
    docs, toxic, passage = planted()
    full = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(240)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    table = spark.read.parquet(str(tmp_path / "documents.parquet"))
    ids, columns = [{i for i, _ in docs}], table.columns
    for name, stage in C.STAGES[:-1]:
        table = stage(spark, table, str(tmp_path))
        assert table.columns == columns, name
        table.write.parquet(str(tmp_path / name))
        table = spark.read.parquet(str(tmp_path / name))
        ids.append({r.doc_id for r in table.collect()})
    assert ids[0] - ids[1] == toxic
    assert ids[1] - ids[2] == {300, 301}
    assert ids[2] - ids[3] == {302}
    assert ids[3] == ids[4]
    text = {r.doc_id: r for r in table.collect()}
    assert text[303].text.endswith("[secret] end") and text[303].n_chars == len(text[303].text) and text[304].text is None
    packed = C.STAGES[-1][1](spark, table, str(tmp_path))
    assert {r.doc_id for r in packed.collect()} == ids[4]
    assert C.run(spark, str(tmp_path)).select("doc_id").distinct().count() == len(ids[4])


def test_near_copies_by_text(spark, tmp_path):
    """Rows that repeat an id go or stay by their text, null ids stay, and clashing extra columns stay as they are."""
    docs, _, _ = planted()
    a, b = docs[1][1], docs[2][1]
    rows = [(3, a, 1, "x"), (5, a + " tail", 2, "x"), (5, b, 3, "x"), (6, b, 4, "x"), (6, None, 5, None), (None, a, 6, "x"), (7, a * 400, 7, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, text_hash bigint, component string")
    out = C.drop_near_copies(spark, df, "")
    assert out.columns == df.columns
    assert sorted(r.text_hash for r in out.collect()) == [1, 3, 5, 6]  # 7 repeats the first text


def test_empty_tables(spark, tmp_path):
    for name, ddl in (
        ("documents", "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string"),
    ):
        spark.createDataFrame([], ddl).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
