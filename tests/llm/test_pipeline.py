"""The pipeline's stages, each on what its predecessor kept, against plain versions."""

import duckdb
import pytest
from conftest import SF
from odd_rows import no_documents, odd_documents
from test_copies import plain_contaminated, plain_fingerprint, plain_groups, plain_repeats

import corpus_pipeline
from tillwater.llm import queries, repeats, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


@pytest.fixture(scope="module")
def kept(spark):
    """Rows of documents and of what each stage keeps, by stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, SF), f"test-{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
        out[name] = docs.collect()
    return out


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash_near_dedup", "suffix_dedup", "benchmark_decontamination",
        "source_mixing"]


def test_toxic_documents_go(spark, kept):
    scores = toxicity.classify(
        spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert ids(kept["toxicity"]) == sorted(
        r["doc_id"] for r in scores.collect() if r["predicted"] == 0)
    assert len(kept["toxicity"]) < len(kept["documents"])


def test_one_of_each_group_stays(kept):
    marks = {r["doc_id"]: plain_fingerprint(r["text"]) for r in kept["toxicity"]}
    least = plain_groups(marks, 3)
    assert ids(kept["simhash_near_dedup"]) == sorted({*least.values()})


def test_repeats_are_cut(kept):
    rows = sorted((r["doc_id"], r["text"]) for r in kept["simhash_near_dedup"])
    got = {r["doc_id"]: r for r in kept["suffix_dedup"]}
    assert sorted(got) == [i for i, _ in rows]
    changed = 0
    for n, bytes_left, removed, _ in plain_repeats(rows, repeats.LENGTH):
        text = got[rows[n][0]]["text"]
        assert got[rows[n][0]]["n_chars"] == len(text)
        # Characters that a span holds in part stay whole.
        assert bytes_left.decode(errors="ignore") == text or removed
        assert 0 <= len(text.encode()) - len(bytes_left) <= 6 * max(1, removed // 100)
        changed += text != rows[n][1]
    assert changed


def test_contaminated_documents_go(kept):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    docs = [(r["doc_id"], r["text"]) for r in kept["suffix_dedup"]]
    found = {i for i, _ in plain_contaminated(docs, items)}
    assert ids(kept["benchmark_decontamination"]) == sorted({i for i, _ in docs} - found)


def test_mixture(kept):
    import pandas as pd

    con = duckdb.connect()
    con.register("documents", pd.DataFrame(
        [tuple(r) for r in kept["benchmark_decontamination"]], columns=COLUMNS))
    want = con.execute(queries.SQL["op5_source_mixing"]).df()
    want = want[want["n_copies"] > 0]
    got = {r["doc_id"]: r["n_copies"] for r in kept["source_mixing"]}
    assert got == dict(zip(want["doc_id"], want["n_copies"], strict=True))


def test_run_is_its_stages(spark, kept):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(map(str, rows)) == sorted(map(str, kept["source_mixing"]))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_bear_odd_rows(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for clashing in (False, True):
        docs = odd_documents(spark, clashing)
        out = stage(spark, docs, SF)
        if name != "source_mixing":
            assert out.columns == docs.columns
        assert out.count() > 0
    assert stage(spark, no_documents(spark), SF).count() == 0


def test_repeated_rows_are_copies(spark):
    out = corpus_pipeline.drop_near_copies(spark, odd_documents(spark), SF).collect()
    found = [r["doc_id"] for r in out]
    assert found.count(1) == 1 and 5 not in found and 6 not in found
    assert found.count(None) == 2


def test_rows_that_share_an_id_go_by_their_own_texts(spark, kept):
    """A clean row stays beside a toxic, a copied and a contaminated row of its id."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_id = {r["doc_id"]: r for r in kept["documents"]}
    stays = kept["benchmark_decontamination"][0]
    toxic = by_id[next(iter(set(by_id) - set(ids(kept["toxicity"]))))]
    copied = by_id[next(iter(set(ids(kept["toxicity"])) - set(ids(kept["simhash_near_dedup"]))))]
    leaked = by_id[next(iter(
        set(ids(kept["suffix_dedup"])) - set(ids(kept["benchmark_decontamination"]))))]
    clean = by_id[stays["doc_id"]]["text"]
    for stage, other in (
        (corpus_pipeline.drop_toxic, toxic), (corpus_pipeline.drop_near_copies, copied),
        (corpus_pipeline.drop_contaminated, leaked),
    ):
        # The clean text alone in the table but for its copy under the other row's id.
        given = docs.where(f"doc_id <> {stays['doc_id']}").unionByName(spark.createDataFrame(
            [(other["doc_id"], clean, "en", "src1", 1)], docs.schema))
        out = stage(spark, given, SF).where(f"doc_id = {other['doc_id']}").collect()
        assert [r["text"] for r in out] == [clean]
