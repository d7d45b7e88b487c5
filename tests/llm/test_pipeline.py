import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def word(rng):
    return "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4)))


def tables(spark, folder):
    rng = random.Random(11)
    passage = " ".join(word(rng) for _ in range(40))
    clean = [" ".join(word(rng) for _ in range(120)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(20, "too short"), (21, "same same " * 60), (22, None), (23, ""), (24, clean[0]), (25, clean[1] + " and more"), (26, clean[2] + " " + passage), (27, " ".join(word(rng) for _ in range(60)) + " write to ann.b@mail7.example.com now"), (28, clean[3].replace(" ", " ### "))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows] + [(None, " ".join(word(rng) for _ in range(50)), None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(0, 1, 0), (20, 0, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, passage), (1, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_stages_and_result(spark, tmp_path):
    docs = tables(spark, str(tmp_path))
    kept, masked = {}, {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        masked = {r.doc_id: r.text for r in docs.collect()}
    all_clean = {*range(12), None}
    assert kept["quality_rules"] == all_clean | {24, 25, 26, 27}
    assert kept["ngram_jaccard_join"] == all_clean | {26, 27}
    assert kept["benchmark_decontamination"] == kept["pii"] == all_clean | {27}
    assert masked[27].endswith(" write to <email> now")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids for i, t in masked.items()}


def test_empty_tables(spark, tmp_path):
    docs = tables(spark, str(tmp_path)).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.collect() == []


def test_columns_with_clashing_names_pass(spark, tmp_path):
    docs = tables(spark, str(tmp_path))
    names = ["base", "further", "text_key", "region", "component_id", "items", "entry", "row", "pii_base", "a.b"]
    for name in names:
        docs = docs.withColumn(name, docs.doc_id)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns[5:] == names
    assert {r.doc_id for r in docs.collect()} == {*range(12), None, 27} == {r.pii_base for r in docs.collect()}
    assert corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).count() == docs.count()
