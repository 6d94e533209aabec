"""The pipeline against its stages done plainly, and every corpus query against its SQL."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from lakeproof.llm.catalog import ORACLES, QUERIES
from lakeproof.llm.packing import cut
from lakeproof.llm.secrets import Efficiency, secret_spans
from lakeproof.llm.spans import redacted
from lakeproof.llm.support import table
from lakeproof.llm.toxicity import learn_lexicon
from tests.llm.fixtures import SF_DIR, awkward, prose
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_similarity import brute as grouped
from tests.llm.test_tokens import ids_of
from tests.oracle import connect, differences


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_query_equals_sql(spark, name):
    assert differences(connect(SF_DIR), QUERIES[name](spark, SF_DIR), ORACLES[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "jaccard_join", "decontamination", "secret_scan", "packing"]


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns


def test_pipeline_equals_plain_stages(spark):
    docs = table(spark, SF_DIR, "documents")
    lexicon = learn_lexicon(docs, table(spark, SF_DIR, "labels"))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    rows = [r for r in rows if lexicon.score(lexicon.load(r[1])[0]) < 0.7]
    kept = {d for d, _, c in grouped(rows) if d == c}
    rows = [r for r in rows if r[0] in kept]
    items = [(r["item_id"], r["text"]) for r in table(spark, SF_DIR, "benchmark").collect()]
    clean = {r[0] for r in contaminated(rows, items) if not r[-1]}
    efficiency = Efficiency()
    rows = [(d, redacted(t, secret_spans(t, efficiency), "[secret]")) for d, t in rows if str(d) in clean]
    expected = sorted((d, k, s, n) for d, t in rows for k, (s, n) in enumerate(cut(len(ids_of(t, "byte_bpe_50k.json", 2)), 1024)))
    found = corpus_pipeline.run(spark, SF_DIR)
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"]) for r in found.collect()) == expected
    assert found.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, term string, hit_id int, _hit_id int, class string, toxic boolean, score double"


def lake(spark, folder, rows, labels, items):
    """A folder with the three tables that the pipeline reads; documents have columns named like its own."""
    filled = [(key, text, None, "s", None if text is None else len(text), 1, "t", 42, 43, "c", None, None) for key, text in rows]
    for name, some, schema in (("documents", filled, SCHEMA), ("labels", labels, "doc_id bigint, quality int, toxic int"), ("benchmark", items, "item_id bigint, text string")):
        spark.createDataFrame(some, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_awkward_documents_pass_through_all_stages(spark, tmp_path):
    passage = prose(30, 301)
    rows = awkward() + [(60, f"{prose(30, 7)} {passage} {prose(30, 8)}"), (61, "token=abcdef123456 " + prose(40, 9)), (62, "you stupid idiot moron"), (63, prose(40, 10)), (64, prose(40, 10) + " x")]
    sf_dir = lake(spark, tmp_path, rows, [(None, 1, 1), (63, None, None)], [(1, passage), (None, None), (2, "")])
    docs, texts = table(spark, sf_dir, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == table(spark, sf_dir, "documents").columns
        texts[name] = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=str)
        assert docs.where("row <> 1 OR hit_id <> 42 OR _hit_id <> 43 OR term <> 't' OR class <> 'c'").count() == 0
    clean = sorted((r for r in rows if r[0] != 62), key=str)
    assert texts["toxicity"] == clean
    # of the long text's three rows and the two that differ by a word one each stays
    left = [r for r in rows if r[0] not in (5, 62, 64)]
    assert texts["jaccard_join"] == sorted(left, key=str)
    assert texts["decontamination"] == sorted((r for r in left if r[0] != 60), key=str)
    assert dict(texts["secret_scan"])[61] == "[secret] " + prose(40, 9)
    found = corpus_pipeline.run(spark, sf_dir)
    assert {r["doc_id"] for r in found.collect()} == {r[0] for r in left} - {60}


def test_empty_tables_pass_through_all_stages(spark, tmp_path):
    assert corpus_pipeline.run(spark, lake(spark, tmp_path / "a", [], [], [])).collect() == []
    found = corpus_pipeline.run(spark, lake(spark, tmp_path / "b", [(1, "one text")], [], []))
    assert [(r["doc_id"], r["piece"]) for r in found.collect()] == [(1, 0)]
