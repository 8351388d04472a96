"""The pipeline: each stage on what the one before kept."""

import pytest

pytest.importorskip("tramline.llm")


def test_stages(spark):
    import corpus_pipeline as c
    from tests.llm.test_llm_brute import ODD, brute_spans, table, words

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for name, stage in c.STAGES[:-1]:
        out = stage(spark, kept[-1], sf)
        assert out.columns == columns, name
        kept.append(spark.createDataFrame(out.collect(), docs.schema))
    text = [{r.doc_id: r.text for r in d.collect()} for d in kept]
    assert all(set(b) <= set(a) for a, b in zip(text, text[1:]))
    norm = lambda t: " ".join(words(t))
    assert len(text[2]) == len({norm(t) for t in text[1].values()})

    def grams(t):
        w = words(t)
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    sets = {i: grams(t) for i, t in text[3].items()}
    ids = sorted(sets)
    assert all(5 * len(sets[a] & sets[b]) < 4 * len(sets[a] | sets[b]) for k, a in enumerate(ids) for b in ids[k + 1 :])
    assert set(text[4]) == set(text[3]) and not any(brute_spans(t) for t in text[4].values())
    assert all(text[4][i] == t for i, t in text[3].items() if not brute_spans(t))
    packed = c.pack(spark, kept[-1], sf)
    assert {r.doc_id for r in packed.collect()} == set(text[4])
    assert c.run(spark, sf).count() == packed.count()
    none = docs.limit(0)
    for _, stage in c.STAGES:
        out = stage(spark, none, sf)
        assert out.count() == 0
    odd = table(spark, ODD)
    for _, stage in c.STAGES[1:-1]:
        odd = spark.createDataFrame(stage(spark, odd, sf).collect(), odd.schema)
    assert odd.columns == table(spark, []).columns and 0 < odd.count() < len(ODD)
