"""Each pipeline stage on its own input against plain versions, and odd rows through all of them."""

import brute
import pytest

import __spark_entry__ as contract
import corpus_pipeline as cp
from lakekit.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input of each stage, and the last result."""
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in cp.STAGES:
        frames.append(materialize(stage(spark, frames[-1], SF), f"test-{name}"))
    return frames


def test_stages_are_the_dealt_ones(stages):
    assert [name for name, _ in cp.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    for frame in stages[:-1]:
        assert frame.columns == stages[0].columns
    assert stages[-1].columns[: len(stages[0].columns)] == stages[0].columns


def test_quality(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1].select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert sum(i in kept for i in bad) <= 0.2 * len(bad)


def test_near_duplicates(stages):
    found = brute.jaccard([(r.doc_id, r.text) for r in stages[1].select("doc_id", "text").collect()], 5, 80)
    assert sorted(r.doc_id for r in stages[2].select("doc_id").collect()) == sorted(i for i, (_, c) in found.items() if i == c)


def test_near_duplicates_of_many_texts_under_one_id(spark, stages):
    text = lambda name, n=40: " ".join(f"{name}{i}" for i in range(n))
    rows = [(1, text("a")), (1, text("b")), (1, text("c")), (1, text("c")), (None, text("d")), (None, text("e")), (None, text("a") + " z")]
    rows += [(2, text("b") + " more"), (0, text("f")), (3, text("f")), (None, None), (None, ""), (None, ""), (7, None), (7, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], stages[0].schema)
    got = sorted(((r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, SF).collect()), key=str)
    want = [(1, text("a")), (1, text("b")), (1, text("c")), (None, text("d")), (None, text("e")), (0, text("f"))]
    assert got == sorted([*want, (None, None), (None, ""), (7, None), (7, "")], key=str)


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = brute.contamination([(r.doc_id, r.text) for r in stages[2].select("doc_id", "text").collect()], items)
    assert sorted(r.doc_id for r in stages[3].select("doc_id").collect()) == sorted(f[0] for f in found if not f[5])


def test_mixing(stages):
    count = lambda frame: sum(len(brute.SPACE.findall(r.text or "")) for r in frame.select("text").collect())
    assert count(stages[4]) == pytest.approx(1.5 * count(stages[3]), rel=0.03)
    texts = {r.doc_id: r.text for r in stages[3].collect()}
    for r in stages[4].collect():
        assert r.text == texts[r.doc_id] or set(r.text.split()) <= set(texts[r.doc_id].split())


def test_sharding(stages):
    key = lambda r: tuple(map(str, (r.doc_id, r.text, r.source)))
    assert sorted(map(key, stages[5].collect())) == sorted(map(key, stages[4].collect()))


def test_run_and_reruns(spark):
    cols = ("doc_id", "text", "shard")
    first, second = (sorted(map(str, contract.queries()["pipeline"](spark, SF).select(*cols).collect())) for _ in range(2))
    assert first == second


def test_odd_rows(spark, stages):
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, "x", "en", "a", 1), (5, "", "en", "a", 0), (5, "", "en", "a", 0), (6, "z " * 50_000, "en", None, 100_000)],
        stages[0].schema,
    )
    for docs in (odd, odd.where("false")):
        for name, stage in cp.STAGES:
            out = materialize(stage(spark, docs, SF), f"odd-{name}")
            assert out.count() <= 2 * docs.count()
            if name == "near_duplicates" and docs.count():
                assert out.count() == 4
