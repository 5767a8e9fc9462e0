"""The pipeline's stages over the smallest tables, each held against brute force on its own input."""

import re
from collections import Counter

import pytest

SF = "/root/testdata/sf0.001"


def shingles(text):
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def similar(a, b):
    both = len(a & b)
    return a == b or both > 0 and both >= 0.8 * (len(a) + len(b) - both)


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    from zonekeep.store import stage

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], SF), "test-" + name.replace(" ", "-")))
    return out


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
    assert 4 <= len(stages) - 1 <= 5


def test_quality_keeps_good_documents(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in stages[1].collect()}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert sum(i in kept for i in bad) <= 0.2 * len(bad) + 1
    texts = {r["doc_id"]: r["text"] for r in stages[0].collect()}
    assert all(r["text"] == texts[r["doc_id"]] for r in stages[1].collect())


def test_one_document_of_each_class_stays(stages):
    before = [(r["doc_id"], shingles(r["text"])) for r in stages[1].orderBy("doc_id").collect()]
    root = {i: i for i, _ in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(before):
        for j, b in before[:n]:
            if similar(a, b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in stages[2].collect()) == sorted({find(i) for i in root})


def test_secrets_go_and_the_rest_stays(stages):
    before, after = {r["doc_id"]: r for r in stages[2].collect()}, {r["doc_id"]: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not re.search(r'token = "[0-9a-f]{40}"|password=[0-9a-f]{18}|AKIA[0-9A-Z]{16}', r["text"])
        assert r["n_chars"] == len(r["text"])
        if "[SECRET]" not in r["text"]:
            assert r["text"] == before[i]["text"]


def test_mix_follows_the_weights(stages):
    size = lambda t: len((t or "").encode().split())
    before, after, most = Counter(), Counter(), Counter()
    for r in stages[3].collect():
        before[r["source"]] += size(r["text"])
        most[r["source"]] = max(most[r["source"]], size(r["text"]))
    for r in stages[4].collect():
        after[r["source"]] += size(r["text"])
    names = sorted(before, key=str.encode)
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, sum(before.values())
    while True:
        free = [s for s in names if s not in fixed]
        share = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > 3 * before[s]]
        if not over:
            break
        fixed |= {s: 3 * before[s] for s in over}
    for s in names:  # whole documents: within the two documents at the ends of the last block
        assert abs(after[s] - fixed.get(s, share * weight[s])) <= 2 * most[s]
    assert max(Counter(r["doc_id"] for r in stages[4].collect()).values()) <= 3


def test_ids_decode_to_the_mix(stages):
    from tokenizers import Tokenizer

    from zonekeep.llm.queries import vocabulary

    library = Tokenizer.from_file(vocabulary())
    texts = Counter((r["doc_id"], r["text"]) for r in stages[4].collect())
    got = Counter((r["doc_id"], library.decode(list(r["ids"]), skip_special_tokens=False)) for r in stages[5].collect())
    assert got == texts
    assert all(r["n_tokens"] == len(r["ids"]) for r in stages[5].collect())


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and columns whose names the stages use themselves."""
    import random

    from pyspark.sql import functions as F
    from tokenizers import Tokenizer

    import corpus_pipeline
    from zonekeep.llm.queries import vocabulary

    rng = random.Random(2)
    words = [a + b for a in ("the", "an", "er", "ing", "tion") for b in ("", "nd", "ti", "es", "or", "ed")]
    plain = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 200))).capitalize() + "." for _ in range(60)]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(plain)]
    rows += [(None, None, None, None, None), (70, "", "en", "s1", 0), (70, "", "en", "s1", 0), (71, " \t\n", None, "", 3), (72, long, "en", None, len(long)), (72, long, "en", None, len(long)), (73, plain[5], "en", "s0", None), (74, "an token=9f8a7d6c5b4a39281706f5e4d3c2b1a0 the", "en", "s2", 45)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("size", "score", "taken", "node", "key", "root", "block", "n_tokens", "row_key"):
        docs = docs.withColumn(c, F.lit(None).cast("int"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(99, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, out, str(tmp_path))
        assert out.columns == docs.columns, name
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library = Tokenizer.from_file(vocabulary())
    kept = {r["doc_id"]: library.decode(list(r["ids"]), skip_special_tokens=False) for r in got}
    assert kept[72] == long and kept[3] == plain[3] and "9f8a7d6c" not in kept.get(74, "") and 73 not in kept
    assert sum(r["doc_id"] in (None, 70, 71) for r in got) <= 1
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
