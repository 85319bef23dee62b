"""The corpus pipeline, each stage against a plain version of it on the stage's own input."""

import corpus_pipeline
import numpy as np
import plain
import public_tokenizers
from kpiwarden.llm import line_dedup, quality
from kpiwarden.llm.queries import oracle_sql, queries
from kpiwarden.sources.scratch import stored
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), "stage")
        if name != "packing":
            assert after.columns == columns
        kept[name] = (docs.collect(), after.collect(), docs)
        docs = after

    before, after, table = kept["quality"]
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(quality.document_statistics(table), labels)
    scores = model.score(quality.statistics([r["text"].encode() for r in before]))
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r, s in zip(before, scores) if s >= 0.3)
    assert {r["doc_id"]: r["text"] for r in after}.items() <= {r["doc_id"]: r["text"] for r in before}.items()

    before, after, _ = kept["lines"]
    rows = [(r["source"], r["text"]) for r in before]
    want = plain.without_boilerplate(rows, line_dedup.RATIO, line_dedup.MIN_PAGES)
    assert {r["doc_id"]: r["text"] for r in after} == {r["doc_id"]: t for r, t in zip(before, want)}
    assert all(r["n_chars"] == len(r["text"]) for r in after)

    before, after, _ = kept["near_duplicates"]
    groups = plain.similar({r["doc_id"]: r["text"] for r in before})
    assert sorted(r["doc_id"] for r in after) == sorted(set(groups.values()))

    before, after, _ = kept["passages"]
    want = plain.without_passages({r["doc_id"]: r["text"] for r in before})
    assert {r["doc_id"]: plain.words(r["text"]) for r in after} == {k: v[0] for k, v in want.items()}

    before, after, _ = kept["packing"]
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r["doc_id"]: len(encode.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in before}
    found = {}
    for r in after:
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
    assert found == want
    sequences = len({r["sequence_id"] for r in after})
    assert sequences <= np.ceil(sum(want.values()) / 2048) + 1


def test_odd_documents_pass_all_stages(spark, tmp_path):
    long = " ".join(f"w{i}" for i in range(300))
    docs = plain.documents(spark, [(1, None), (2, ""), (3, long), (3, long), (4, long), (None, "x y"), (5, "a\n" * 5000)])
    labels = spark.createDataFrame([(1, 1), (3, 1), (None, 0)], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for empty in (False, True):
        rows = docs.limit(0) if empty else docs
        for _, stage in corpus_pipeline.STAGES:
            rows = stored(stage(spark, rows, str(tmp_path)), "stage")
        ids = {r["doc_id"] for r in rows.collect()}
        assert ids == (set() if empty else {1, 2, 3, None, 5})


def test_copies_over_the_ratio_keep_one_document(spark, tmp_path):
    prose = lambda i, n: " ".join(f"w{i}x{k}" for k in range(n))
    page = [prose(f"near{k}", 12) for k in range(40)]
    near = [[prose(f"edit{k}", 12) if j == k else x for j, x in enumerate(page)] for k in range(10)]
    exact = "\n".join(prose(f"copy{k}", 9) for k in range(4))
    blank = "\n".join(prose(f"blank{k}", 9) for k in range(4))
    rows = [(k, exact) for k in range(8)] + [(10 + k, "\n".join(x)) for k, x in enumerate(near)]
    rows += [(30 + k, blank + "\n" * k) for k in range(8)]
    rows += [(100 + k, f"the menu\n{prose(k, 15)}") for k in range(40)]
    docs = plain.documents(spark, rows)
    after = corpus_pipeline.lines(spark, docs, str(tmp_path))
    after = corpus_pipeline.near_duplicates(spark, stored(after, "lines"), str(tmp_path))
    texts = {r["doc_id"]: r["text"] for r in after.collect()}
    assert [k for k in texts if k < 10] == [0] and texts[0] == exact
    assert [k for k in texts if 10 <= k < 30] == [10] and texts[10] == "\n".join(near[0])
    assert [k for k in texts if 30 <= k < 100] == [30] and texts[30] == blank
    assert {texts[100 + k] for k in range(40)} == {prose(k, 15) for k in range(40)}


def test_near_duplicates_of_null_and_repeated_ids(spark):
    long = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(4)]
    rows = [(None, "alone"), (None, long[0]), (None, long[0] + " x"), (1, long[1]), (None, long[1] + " x")]
    rows += [(2, long[2]), (7, long[2] + " x"), (7, long[3]), (9, long[3] + " x"), (3, ""), (None, None)]
    after = corpus_pipeline.near_duplicates(spark, plain.documents(spark, rows), SF)
    found = [(r["doc_id"], r["text"]) for r in after.collect()]
    own = [(i, t) for i, t in found if t in (long[0], long[0] + " x")]
    assert len(own) == 1 and own[0][0] is None
    want = [(None, "alone"), (1, long[1]), (2, long[2]), (7, long[3]), (3, ""), (None, None)]
    assert sorted(found, key=str) == sorted(want + own, key=str)


def test_run_equals_its_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)


def test_every_operator_is_registered():
    names = queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(oracle_sql()) <= set(names)
