"""The pipeline's stages on a small corpus with planted cases."""

from __future__ import annotations

import random

import pytest

from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from creditweave.llm.common import free_memory
from creditweave.llm.queries import ORACLES, QUERIES
from tests.compare import assert_same


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(21)
    plain = ["".join(rng.choices("abdeinorst", k=rng.randint(2, 7))) for _ in range(900)]

    def text(n):
        return " ".join(rng.choices(plain, k=n))

    passage, item = text(80), text(30)
    rows = {k: text(rng.randint(40, 120)) for k in range(200)}
    labels = []
    for k in range(0, 120, 4):
        rows[k] += " you idiot and moron "
        labels.append((k, 1))
    labels += [(k, 0) for k in range(120) if k % 4]
    rows[300], rows[301] = rows[150], rows[151].replace(rows[151].split(" ")[5], "changed", 1)
    rows[302], rows[303] = text(40) + " " + passage + " " + text(40), text(40) + " " + passage + " " + text(40)
    rows[304] = text(30) + " " + item + " " + text(30)
    root = str(tmp_path_factory.mktemp("planted"))
    table = [(k, t, "en", "s", len(t)) for k, t in rows.items()] + [(400, None, "en", "s", 0), (401, "", "en", "s", 0), (None, text(50), "en", "s", 9)]
    spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(k, 1, y) for k, y in labels], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root, rows, passage


def test_planted_cases(spark, planted):
    root, rows, passage = planted
    got = {r.doc_id: r for r in pipeline.run(spark, root).collect()}
    toxic = {k for k in range(0, 120, 4)}
    assert set(got) == set(rows) - toxic - {300, 301, 304} | {400, 401, None}
    assert passage in got[302].text and passage not in got[303].text and got[303].n_chars == len(got[303].text) < len(rows[303])
    assert got[400].text is None and got[401].text == "" and got[400].token_ids == [] and len(got[5].token_ids) > 0
    assert all(got[k].text == rows[k] for k in range(150, 200))


#: Names that the stages and their operators use themselves.
INTERNAL = (
    "key _key tag spans kept n_bytes n_removed n_spans kept_sha256 row given given_id given_hash _id _hash text_hash words seed at item item_id item_hash size start"
    " score predicted toxic _toxic node label n prefix component_id component_key n_shingles _grouped group home token token_ids position"
).split()


def test_stages_keep_any_column(spark, planted):
    """Columns with the names that a stage uses come back with their own values, on an empty table as well."""
    docs = spark.read.parquet(f"{planted[0]}/documents.parquet").filter("doc_id < 40 or doc_id between 150 and 160 or doc_id >= 300 or doc_id is null")
    before = {r.doc_id: r for r in docs.collect()}
    docs = docs.withColumns({name: F.concat(F.lit(f"{name} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for name in INTERNAL})
    for name, stage in pipeline.STAGES:
        last = name == pipeline.STAGES[-1][0]
        done = stage(spark, docs, planted[0])
        kept = [f for f in docs.schema.fields if not (last and f.name == "token_ids")]
        assert [(f.name, f.dataType) for f in done.schema.fields if f.name != "token_ids" or not last] == [(f.name, f.dataType) for f in kept], name
        rows = done.collect()
        assert len(rows) > 10
        for r in rows:
            own = "none" if r.doc_id is None else r.doc_id
            assert all(r[c] == f"{c} of {own}" for c in INTERNAL if not (last and c == "token_ids")), name
            assert (r.lang, r.source) == (before[r.doc_id].lang, before[r.doc_id].source)
        assert stage(spark, docs.limit(0), planted[0]).count() == 0, name


def test_one_of_repeated_rows_stays(spark, planted):
    docs = spark.read.parquet(f"{planted[0]}/documents.parquet").filter("doc_id between 150 and 160 or doc_id >= 400")
    assert pipeline.drop_near_duplicates(spark, docs.unionAll(docs), planted[0]).filter("doc_id < 400").count() == 11


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), sf_dir, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_workers_give_back_what_a_task_used(spark):
    """Large tables of a finished task are not held by the Python worker that goes on to other stages."""

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def run(batches):
        yield from batches
        held = [[str(k + j) for k in range(20_000)] for j in range(50)]  # small objects, as memos hold them
        held.append(held)  # a cycle, as between an object and a memo of its method
        most = resident()
        del held
        free_memory()
        assert resident() < most - 20_000_000, (most, resident())

    assert spark.range(4, numPartitions=1).mapInArrow(run, "id long").count() == 4
