"""The pipeline against its stages worked by other means."""

import duckdb
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from accesslake.llm import decontam, toxicity
from test_minhash import brute_force

SF = "/root/testdata/sf0.001"


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    left = {i: r for i, r in rows.items() if model.text_score(r.text) < 0.5 and any(map(str.isalpha, r.text))}
    groups = brute_force([(i, r.text) for i, r in left.items()], 5, 80)
    left = {i: r for i, r in left.items() if groups[i][1] == i}
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'; create view benchmark as select * from '{SF}/benchmark.parquet'")
    leaks = {x[0] for x in con.execute(decontam.ORACLE_SQL).fetchall()}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {i: len(library.encode(r.text, add_special_tokens=False).ids) for i, r in left.items() if i not in leaks}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in got} == expected and len(got) == len(expected)
    assert 0 < len(got) < len(rows) and all(len(r.ids_le) == 4 * r.n_tokens for r in got)


def test_stages_keep_columns_and_odd_rows(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text, "en", 0.5, "x"), (1, text, "en", 0.5, "x"), (2, text, "en", None, None), (3, None, None, None, None), (None, "the cat and the dog", "en", 1.0, "y"),
            (4, "", "en", 1.0, "y"), (5, "of the man and the house", "en", 2.0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, kept string").repartition(3)
    for t, schema, some in (("labels", "doc_id long, toxic int", [(2, 0)]), ("benchmark", "item_id long, text string", [(1, "of the man and the house"), (2, None)])):
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{t}.parquet")
    counts = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before, docs = docs, stage(spark, docs, str(tmp_path))
        counts.append(docs.count())
        assert k == 4 or docs.columns == before.columns
    assert counts == [7, 5, 3, 2, 2]
    assert {r.doc_id for r in docs.collect()} == {None, 1}


def test_columns_with_clashing_names(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(40))
    names = ["_id", "_hash", "_dropped_0", "_dropped_1", "row", "row_hash", "kept", "id", "node", "fp"]
    rows = [(i, t, "en", *range(len(names))) for i, t in ((1, text), (1, text), (2, text + " end"), (3, "of the man and the house"), (None, "the cat"), (4, "the dog"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"{n} int" for n in names))
    for t, schema, some in (("labels", "doc_id long, toxic int", [(3, 0)]), ("benchmark", "item_id long, text string", [(1, "of the man and the house")])):
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{t}.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.columns == before.columns
    assert sorted(map(tuple, docs.collect()), key=str) == sorted((rows[0], rows[4], rows[5]), key=str)


def test_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for t, schema in (("documents", docs.schema), ("labels", "doc_id long, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_leaks_are_dropped_by_id_and_text(spark, tmp_path):
    leak = " ".join(f"item{i}" for i in range(30))
    clean = [(None, "clean text of no id that stays here"), (None, None), (7, "another clean text of a repeated id"), (8, "alone")]
    docs = spark.createDataFrame([(None, "so " + leak), (7, leak + " end"), (9, leak), *clean], "doc_id long, text string").repartition(3)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.drop_benchmark(spark, docs, str(tmp_path)).collect()
    assert sorted(map(tuple, left), key=str) == sorted(clean, key=str)
