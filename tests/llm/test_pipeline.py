"""The pipeline against plain versions of its stages, each on the input that it got."""

from __future__ import annotations

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from logharbor.llm import bpe, lines, toxicity
from logharbor.llm.common import read_table, session, written
from tests.llm.conftest import component_ids, near_lines, shingles

SF = "/root/testdata/sf0.001"


def texts(docs) -> list[tuple]:
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_stages_do_what_plain_python_does(llm):
    docs = read_table(llm, SF, "documents")
    extra = llm.createDataFrame([(None, None, 1), (9_000_001, "", 1), (9_000_002, "one two", 1)], "doc_id long, text string, key int")
    docs = docs.withColumn("key", F.lit(1)).unionByName(extra, allowMissingColumns=True)
    columns = docs.columns
    model = toxicity.train(docs, read_table(llm, SF, "labels"))
    toxic = {r.doc_id for r in toxicity.score(docs, model).where(F.col("toxicity") >= 0.5).collect()}

    first = written(corpus_pipeline.drop_toxic(llm, docs, SF), "test")
    assert sorted(texts(first), key=repr) == sorted([r for r in texts(docs) if r[0] not in toxic], key=repr)

    second = written(corpus_pipeline.dedup_lines(llm, first, SF), "test")
    want = near_lines(texts(first), lines.edit_distance, lines.LEAST_BYTES, lines.EDITS)
    left = [(i, text) for i, _, dropped, _, _, text in want if not dropped or text.strip()]
    assert sorted([(i, t or "") for i, t in texts(second)], key=repr) == sorted(left, key=repr)
    assert all(r.n_chars == len(r.text) for r in second.where("n_chars is not null").collect())

    third = written(corpus_pipeline.dedup_near(llm, second, SF), "test")
    component = component_ids([r for r in texts(second) if r[0] is not None])
    assert {i for i, _ in texts(third)} == {i for i, c in component.items() if i == c} | {None}

    fourth = written(corpus_pipeline.drop_contaminated(llm, third, SF), "test")
    items = [shingles(r.text) for r in read_table(llm, SF, "benchmark").collect()]
    clean = [(i, t) for i, t in texts(third) if not any(s and 100 * len(s & shingles(t)) >= 75 * len(s) for s in items)]
    assert sorted(texts(fourth), key=repr) == sorted(clean, key=repr)
    assert all(stage.columns == columns for stage in (first, second, third, fourth))

    library = Tokenizer.from_file(bpe.TOKENIZER)
    for row in corpus_pipeline.tokenize(llm, fourth, SF).join(fourth.select("doc_id", "text"), "doc_id").collect():
        assert row.token_ids == library.encode(row.text or "", add_special_tokens=False).ids


def test_an_empty_table_passes_all_stages(llm):
    docs = read_table(llm, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(llm, docs, SF), "test")
    assert docs.count() == 0


def test_run_gives_the_rows_of_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF)
    docs = read_table(session(spark), SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test")
    assert sorted(r.doc_id for r in rows.collect()) == sorted(r.doc_id for r in docs.collect())
