"""The pipeline on small tables: each stage's decisions against plain code over its own input."""

import os

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as cp
from packetmill.llm import base
from packetmill.llm import decontaminate as dc
from packetmill.llm import personal_data as pd_
from packetmill.llm import quality_gam as qg

FOLDER = "/root/testdata/sf0.01"


def shingles(text):
    words = dc._WORD.findall(text.lower().encode())
    return {b" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept, columns = {}, docs.columns
    for k, (name, stage) in enumerate(cp.STAGES):
        made = stage(spark, docs, FOLDER)
        assert k == len(cp.STAGES) - 1 or made.columns == columns
        made.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        kept[name] = ({r.doc_id: r for r in before.collect()}, docs)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    before, after = kept["quality classifier"]
    rejected = set(before) - {r.doc_id for r in after.collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert rejected and not rejected & good
    assert rejected == {r.doc_id for r in qg.score(spark.read.parquet(f"{FOLDER}/documents.parquet"), qg.fit(spark.read.parquet(f"{FOLDER}/documents.parquet"), labels)).where("predicted = 0").collect()}

    before, after = kept["near-duplicates"]
    left = {r.doc_id: shingles(r.text) for r in after.collect()}
    for i in set(before) - set(left):
        own = shingles(before[i].text)
        assert any(len(own & s) / len(own | s) > 0.6 for s in left.values())
    texts = [before[i].text for i in left]
    assert len(texts) == len(set(texts))
    close = [(i, j) for i in left for j in left if i < j and len(left[i] & left[j]) >= 0.9 * len(left[i] | left[j])]
    assert not close

    before, after = kept["decontamination"]
    items = [shingles(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    dirty = {i for i, r in before.items() if any(len(t & shingles(r.text)) >= 0.8 * len(t) for t in items)}
    assert dirty and set(before) - {r.doc_id for r in after.collect()} == dirty

    before, after = kept["personal data"]
    for r in after.collect():
        assert pd_.base_spans(r.text) == [] and r.n_chars == len(r.text)
        assert r.text == before[r.doc_id].text or pd_.candidates(before[r.doc_id].text)

    before, after = kept["packing"]
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = after.groupBy("doc_id").sum("length").collect()
    assert {r.doc_id: r["sum(length)"] for r in pieces} == {i: len(slow.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in before.items()}


def test_near_duplicates_tell_equal_ids_apart(spark, tmp_path):
    rows = [(1, "one two three four five six seven", "l", "s", 1), (1, "one two three four five six seven", "l", "s", 1), (None, "something else altogether is written here", "l", "s", 1), (None, None, None, None, None), (None, None, None, None, None), (1, "a third text under the same id as before", "l", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/d")
    out = cp.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/d"), FOLDER)
    assert sorted((r.doc_id or 0, r.text or "") for r in out.collect()) == sorted([(1, rows[0][1]), (0, rows[2][1]), (0, ""), (1, rows[5][1])])


def test_run_and_empty(spark, tmp_path):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_row_numbers_do_not_depend_on_the_plan(spark, tmp_path):
    """Numbers, and the documents kept, stay as they are when a scan is planned for more or fewer cores."""
    from packetmill.llm.base import stable_numbers

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.repartition(6).write.parquet(f"{tmp_path}/six")
    six = spark.read.parquet(f"{tmp_path}/six")
    rows, row = stable_numbers(six, "rows")
    seen = []
    for least in ("1", "4", "17"):
        spark.conf.set("spark.sql.files.minPartitionNum", least)
        again, _ = stable_numbers(spark.read.parquet(f"{tmp_path}/six"), "rows")
        seen += [{(r.doc_id, r.text, r[row]) for r in t.select("doc_id", "text", row).collect()} for t in (rows, again)]
    spark.conf.unset("spark.sql.files.minPartitionNum")
    assert len(seen[0]) == docs.count() and all(x == seen[0] for x in seen) and len({x[2] for x in seen[0]}) == docs.count()
    made, name = stable_numbers(spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "row long, text string"), "rows")
    assert name != "row" and made.select(name).distinct().count() == 3


def test_scratch_tables_of_a_settled_table_go(spark):
    made = []

    def make():
        made.extend([base.materialise(spark.range(5), "part"), base.materialise(spark.range(7), "part")])
        return made[0].union(made[1])

    out = base.settled(make, "whole")
    assert out.count() == 12 and os.path.exists(out._scratch.removeprefix("file://"))
    assert not any(os.path.exists(t._scratch.removeprefix("file://")) for t in made)
    assert base._WRITTEN.get() is None
