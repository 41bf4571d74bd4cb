import random

import corpus_pipeline as cp
from odd_rows import SCHEMA, odd_documents, sentence
from test_joins import check_dedup, joined, slow_set


def test_stages(spark, tmp_dir):
    rng = random.Random(8)
    rows = [r[:5] for r in odd_documents()]
    rows += [(200 + i, sentence(rng, 60), "en", f"s{i % 3}", 1) for i in range(30)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    seen = {}
    for name, stage in cp.STAGES:
        stage(spark, docs, tmp_dir).write.parquet(f"{tmp_dir}/{name}")
        seen[name] = [tuple(r) for r in docs.collect()]
        docs = spark.read.parquet(f"{tmp_dir}/{name}")
        if name != "packing":
            assert docs.columns == list(cp.COLUMNS)
    last = docs.collect()
    # 1: documents without a letter go, others keep id and text
    kept = seen["ngram_near_duplicates"]
    assert sorted(r[0] for r in kept if r[0] is not None) == sorted(
        r[0] for r in rows if r[0] is not None and any(c.isalpha() for c in r[1] or ""))
    # 2: one of each group, the smallest doc_id
    sets = [(r[0], slow_set(r[1])) for r in kept if r[0] is not None]
    groups = joined({i for i, _ in sets}, [
        (a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
        if x and y and 100 * len(x & y) >= 80 * len(x | y)])
    assert sorted(r[0] for r in seen["suffix_dedup"] if r[0] is not None) == sorted(
        {i for i, g in groups.items() if i == g})
    # 3: repeated passages are cut
    from tableops.llm import bwt_dedup
    check_dedup([r[:2] for r in seen["suffix_dedup"]], bwt_dedup.deduplicate(
        spark.createDataFrame(seen["suffix_dedup"], schema)).collect())
    assert len(seen["source_mix"]) == len(seen["suffix_dedup"])
    # 4: a document three times at the most, and only documents of the stage
    before = {(r[0], r[1]) for r in seen["source_mix"]}
    mixed = [(r[0], r[1]) for r in seen["packing"]]
    assert set(mixed) <= before and max(map(mixed.count, mixed)) <= 3
    # 5: every copy is packed once
    assert sum(r.piece == 0 for r in last) == len(mixed)


def test_empty_table(spark, tmp_dir):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, tmp_dir)
        assert docs.count() == 0


def test_registered():
    import __spark_entry__ as entry
    names = [q for q in entry.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()
