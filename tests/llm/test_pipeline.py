"""The corpus pipeline stage by stage on a small corpus with planted cases."""

import random
import zlib
from collections import Counter

import pytest

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLEAN, TOXIC, COPY, NEAR, LEAK, SECRET = range(0, 300), range(1000, 1100), range(2000, 2020), range(3000, 3020), range(4000, 4010), range(5000, 5010)


def _corpus():
    rng = random.Random(12)
    vocabulary = ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    texts = {k: text(rng.randint(20, 120)) for k in CLEAN}
    texts |= {k: text(30) + " vile scumbag moron " + text(30) for k in TOXIC}
    texts |= {k: texts[k - 2000] for k in COPY}
    for k in NEAR:
        words = texts[k - 3000 + 100].split() + ["extra"]
        texts[k] = " ".join(words)
    items = {i: text(25) for i in range(10)}
    texts |= {k: text(40) + " " + items[k - 4000] + " " + text(40) for k in LEAK}
    texts |= {k: text(20) + f" mail user{k}@example.org or 10.0.0.{k % 200} now " + text(20) for k in SECRET}
    docs = [(k, t, "en", f"s{k % 3}", len(t)) for k, t in texts.items()] + [(9000, None, None, None, None), (9001, "", "en", "s0", 0)]
    labels = [(k, 1, int(k in TOXIC)) for k in texts]
    return docs, labels, list(items.items())


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs, labels, items = _corpus()
    spark.createDataFrame(docs, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, folder))
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert len(kept[name]) == docs.count()
    everything = {r[0]: r[1] for r in _corpus()[0]}
    held_out = [k for k in TOXIC if zlib.crc32(str(k).encode()) % 5 == 0]
    assert held_out and set(everything) - set(kept["toxicity"]) == set(TOXIC)
    gone = set(kept["toxicity"]) - set(kept["near_duplicates"])
    assert gone == set(COPY) | {k for k in NEAR if len(everything[k].split()) - 5 >= 4}  # one more shingle in at least four
    assert set(kept["near_duplicates"]) - set(kept["decontamination"]) == set(LEAK)
    masked = kept["personal_data"]
    assert set(masked) == set(kept["decontamination"])
    for k, text in masked.items():
        if k in SECRET:
            expected = everything[k].replace(f"user{k}@example.org", "[EMAIL]").replace(f"10.0.0.{k % 200}", "[IP]")
            assert text == expected
        else:
            assert text == everything[k]
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    size = lambda k: len((masked[k] or "").split())
    taken = Counter()
    for row in mixed:
        taken[row["source"]] += size(row["doc_id"])
    whole = sum(map(size, masked))
    weight = {"s0": 1, "s1": 2, "s2": 3}
    largest = max(map(size, masked))
    for source, share in weight.items():
        assert abs(taken[source] - whole * share / 6) <= 3 * largest
    assert set(r["doc_id"] for r in mixed) <= set(masked)


def test_run_is_the_stages_together(spark, folder):
    rows = corpus_pipeline.run(spark, folder).select("doc_id", "text").collect()
    again = corpus_pipeline.run(spark, folder).select("doc_id", "text").collect()
    assert sorted(rows, key=repr) == sorted(again, key=repr) and len(rows) > 200


def test_empty_corpus(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
