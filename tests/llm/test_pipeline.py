"""Every stage of the pipeline against a brute-force version, on the smallest tables."""

import os

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

import corpus_pipeline as P  # noqa: E402
from ledgerlens.llm import feistel, toxicity  # noqa: E402
from ledgerlens.llm.queries import DEMO_KEY, ORACLE, QUERIES, table, tokenizer_path  # noqa: E402

from .test_decontam import brute as contamination  # noqa: E402
from .test_hyperminhash import brute as duplicates  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    outs = []
    for k, (name, stage) in enumerate(P.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert k == len(P.STAGES) - 1 or docs.columns == columns
        outs.append(rows(docs))
    given = rows(table(spark, SF, "documents"))
    # Toxicity: the model's scores, one by one; labelled texts mostly as labelled.
    all_docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    model = toxicity.fit(all_docs, labels.where(~toxicity.held_out()))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(all_docs, model).collect()}
    assert set(outs[0]) == {d for d, s in scores.items() if s < toxicity.THRESHOLD}
    # One of each group of near-duplicates stays.
    kept = {int(d) for d, _, _, k in duplicates([(d, r["text"]) for d, r in outs[0].items()]) if k}
    assert set(outs[1]) == kept
    # Benchmark passages are cut out.
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    want = {int(r[0]): r[5] for r in contamination([(d, r["text"]) for d, r in outs[1].items()], items)}
    assert {d: r["text"] for d, r in outs[2].items()} == want
    # Personal values are replaced.
    want = {d: feistel.pseudonymise_text(r["text"], DEMO_KEY)[0] for d, r in outs[2].items()}
    assert {d: r["text"] for d, r in outs[3].items()} == want
    for out in outs[:4]:
        assert all(r["n_chars"] == len(r["text"]) and r["lang"] == given[d]["lang"] for d, r in out.items())
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = {d: library.encode(r["text"], add_special_tokens=False).ids for d, r in outs[3].items()}
    assert {d: r["ids"] for d, r in outs[4].items()} == want
    assert len(outs[4]) > 100


def test_stages_take_odd_documents(spark, odd_docs, tmp_path):
    for docs, n in ((odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), 0), (odd_docs.limit(0), 1)):
        for k, (name, stage) in enumerate(P.STAGES):
            path = str(tmp_path / f"{n}-{k}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
        assert (docs.count() > 10) == (n == 0)


def test_run_equals_stages(spark):
    got = P.run(spark, SF)
    assert got.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"] and got.count() > 100


def test_one_query_each():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
