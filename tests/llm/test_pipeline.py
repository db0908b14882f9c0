"""Every stage of the pipeline against brute force over what its predecessor kept."""

import re
from collections import defaultdict

import corpus_pipeline as cp
from coursepulse.llm import quality, toxicity
from coursepulse.llm.scratch import written
from tests.llm.test_operators import brute_components

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in cp.STAGES[:-1]:
        after, _ = written(stage(spark, docs, SF), "stage")
        assert after.columns == columns
        kept.append((docs, after))
        docs = after
    texts = [{r.doc_id: r.text for r in a.collect()} for a, _ in kept]
    left = [{r.doc_id for r in b.collect()} for _, b in kept]
    assert left[0] == {r.doc_id for r in quality.judge(kept[0][0]).collect() if r.kept}
    scores = toxicity.scores(kept[1][0], spark.read.parquet(f"{SF}/labels.parquet"))
    assert left[1] == {r.doc_id for r in scores.collect() if not r.predicted}
    groups = defaultdict(list)
    for i, t in texts[2].items():
        groups[re.sub(r"[\x20\x09-\x0D]", "", t)].append((-len(t), i))
    assert left[2] == {min(g)[1] for g in groups.values()}
    assert left[3] == {i for i, (_, c) in brute_components(list(texts[3].items())).items() if c == i}
    rows = cp.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == left[3]
    used = defaultdict(int)
    for r in rows:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096 and len(used) <= -(-sum(used.values()) // 4096) + 1


def test_nulls_repeats_long_texts_clashing_names_and_an_empty_table(spark, edge, tmp_path):
    from tests.llm.conftest import LONG

    for name, rows in (("some", edge), ("none", edge.limit(0))):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    kept = quality.keep_documents(edge).collect()
    want = {r.doc_id for r in kept}
    got = cp.run(spark, f"{tmp_path}/some").collect()
    ids = {r.doc_id for r in got}
    assert ids <= want and not ids & {0, 1, 2, 7, 8}  # null, empty, white space, two words
    texts = {re.sub(r"[\x20\x09-\x0D]", "", r.text) for r in kept}
    assert ids and len(ids) <= len(texts) and not {3, 10} <= ids  # the long text and its near copy
    assert (3 in want or 10 in want) == bool({3, 10} & ids) and len(LONG) > 200_000
    pieces = [(r.doc_id, r.piece) for r in got]
    assert len(pieces) == len(set(pieces))  # the repeated row left one
    assert cp.run(spark, f"{tmp_path}/none").collect() == []
