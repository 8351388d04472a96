"""Operators do the whole job: cases that a cut, a bound or a shortcut would lose."""

import pytest

pytest.importorskip("tramline.llm")

DOCS = "doc_id long, text string"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_on_the_given_embeddings(spark, sf):
    """Production parameters against all distances, every row a query."""
    import numpy as np

    from tramline.llm.ann import nearest_neighbours

    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in nearest_neighbours(df, query_every=1).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = {}
    for at, q in enumerate(ids.tolist()):
        d = np.sqrt(((x - x[at]) ** 2).sum(1))
        d[at] = np.inf
        hit[q] = len(got[q] & set(ids[np.lexsort((ids, d))[:10]].tolist()))
    stated = [n for q, n in hit.items() if q % 100 == 0]
    assert sum(hit.values()) >= 9 * len(hit) and sum(stated) >= 9 * len(stated)


def test_rare_toxic_word_behind_many_common_terms(spark):
    """Over 5,000 terms reach more toxic texts than the one that tells them."""
    import random

    from tramline.llm.toxicity import learn

    rng = random.Random(0)
    common = " ".join({"".join(rng.choices("bcdfghjkmnpqrtvw", k=8)) for _ in range(1_500)})
    toxic = {i: i % 2 for i in range(60)}
    docs = spark.createDataFrame([(i, common + (" zorkbat" if t and i % 3 else "")) for i, t in toxic.items()], DOCS)
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    lexicon = learn(docs, labels)
    assert any("zork" in t for t in lexicon.weights)
    assert lexicon.features("a zorkbat here")[0] > 0 == lexicon.features(common)[0]


def test_revealing_terms_far_from_the_entity(spark):
    """A name 300 characters before the address is taken out, at all its places in documents that hold the entity."""
    from tramline.llm.pii import find_personal_data, sanitised

    gap = " ".join(f"plain{k}" for k in range(50))
    rows = [(i, f"Zebulon begins. {gap} write to bob@example.com now. {gap} é zebulon ends") for i in range(4)]
    rows += [(10 + i, f"other text. {gap} number {i}") for i in range(60)]
    docs = spark.createDataFrame(rows, DOCS)
    t = rows[0][1]
    want = [("term", t.index("Zebulon")), ("term", t.index("zebulon")), ("email", t.index("bob@"))]
    spans = {r.doc_id: [(s.kind, s.start) for s in r.spans] for r in find_personal_data(docs).collect()}
    assert {(4 if k == "term" else 0, at) for k, at in want} <= set(spans[0]) and not spans[10]
    clean = {r.doc_id: r.text for r in sanitised(docs).collect()}
    assert all("zebulon" not in clean[i].lower() and gap in clean[i] for i in range(4)) and clean[12] == rows[6][1]


def test_terms_are_generalised_by_what_they_are(spark):
    """A term whose share is between the thresholds gives way to its class, one above to nothing; entities to their kind."""
    from tramline.llm.pii import sanitised

    # bob is in 8 of 400 documents; "Harbour" and "4711" in these 8 and 10 others, "Zebulon" in these 8 alone.
    rows = [(i, f"Zebulon of Harbour 4711 wrote x{i}y from bob@example.com") for i in range(8)]
    rows += [(10 + i, f"Harbour 4711 and line x{i}") for i in range(8)] + [(100 + i, f"plain line of what he wrote from {i}") for i in range(384)]
    clean = {r.doc_id: r.text for r in sanitised(spark.createDataFrame(rows, DOCS)).collect()}
    assert clean[3] == " of [NAME] [NUMBER OF 4 DIGITS] wrote x3y from [EMAIL]", clean[3]
    assert clean[12] == rows[10][1] and clean[200] == "plain line of what he wrote from 100"


def test_toxic_rows_of_the_held_out_fold(spark):
    """Recall on toxic rows and share of clean rows rejected, with production parameters; accuracy alone would say little."""
    from tramline.llm.toxicity import score_toxicity

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = score_toxicity(docs.join(labels, "doc_id", "left_semi"), labels).where("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    toxic, clean = ([r.predicted for r in rows if r.toxic == k] for k in (1, 0))
    assert sum(toxic) >= 0.88 * len(toxic) > 50 and sum(clean) <= 0.01 * len(clean)


def test_words_made_to_share_a_polynomial_hash(spark):
    """A Thue-Morse word and its complement cancel out in any sum of powers modulo 2**64; here they are two words."""
    import public_tokenizers
    from tokenizers import Tokenizer

    from tramline.llm.lm import score_documents
    from tramline.llm.ngram_join import near_duplicates
    from tramline.llm.packing import Encoder
    from tramline.llm.substring_dedup import without_repeats
    from pyspark.sql import functions as F

    bits = [bin(i).count("1") % 2 for i in range(1024)]
    one, two = ("".join("ab"[b ^ x] for b in bits) for x in (0, 1))
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, encode = Tokenizer.from_file(path), Encoder(path)
    for w in (one, two, f"{one} {two}"):
        assert encode(w) == b"".join(i.to_bytes(4, "little") for i in tok.encode(w, add_special_tokens=False).ids)
    tail = " ".join(f"word{k}" for k in range(60))
    lists = [" ".join("ab"[b ^ x] for b in bits) for x in (0, 1)]
    docs = spark.createDataFrame([(1, one), (2, two), (3, f"{one} {tail}"), (4, f"{two} {tail}"), (5, lists[0]), (6, lists[1])], DOCS)
    classes = {r.doc_id: r.class_id for r in near_duplicates(docs).collect()}
    assert classes[1] != classes[2]
    counts = {r.doc_id: (r.n_known, r.train_tokens) for r in score_documents(docs, F.col("doc_id") == 2, vocabulary=50).collect()}
    assert counts[2] == (2, 2 + 62 + 62 + 1025 + 1025)  # `two` stands in document 4 as well, every text has an end
    alone = {r.doc_id: r.n_known for r in score_documents(docs.where("doc_id < 3"), F.col("doc_id") == 2, vocabulary=50).collect()}
    assert alone[2] == 1  # its end alone
    gone = {r.doc_id: r.n_removed for r in without_repeats(docs).collect()}
    seen = {tuple(lists[0].split()[k : k + 50]) for k in range(975)}
    own, covered = lists[1].split(), set()
    for k in range(975):
        if tuple(own[k : k + 50]) in seen:
            covered.update(range(k, k + 50))
    assert gone[4] == 60 and gone[2] == 0 and gone[6] == len(covered)


def test_components_of_stars_chains_and_loops(spark):
    """A star of 300 around its largest and its smallest node, a chain, loops and repeats, dealt in 3 parts a node."""
    import random

    from tramline.llm.graph import components

    rng = random.Random(3)
    edges = [(0, k) for k in range(1, 300)] + [(999, 400 + k) for k in range(300)] + [(1000 + k, 1001 + k) for k in range(40)] + [(5, 5), (1, 0), (2000, 2000)]
    edges += [(3000 + rng.randrange(60), 3000 + rng.randrange(60)) for _ in range(45)]
    root = {x: x for e in edges if e[0] != e[1] for x in e}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    got = components(spark.createDataFrame(edges, "a long, b long"), salts=3).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((x, top(x)) for x in root)


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_the_network_learns_from_every_training_document(spark, block_bytes):
    """Words turned round in documents that a quarter would leave out: the counts stay, the model does not."""
    import numpy as np
    from pyspark.sql import functions as F

    from tramline.llm.lm import score_documents
    from tramline.llm.shared import mix

    ids = np.arange(400, dtype=np.int64)
    lot = (mix(ids.view(np.uint64) + np.uint64(5)) >> np.uint64(11)) / 2.0**53
    left_out = set(ids[lot >= 0.25].tolist()) - {7}
    text = lambda k: [f"w{(k + j * (1 + k % 3)) % 40}" for j in range(30)]
    score = []
    for turned in (False, True):
        rows = [(k, " ".join(text(k)[::-1] if turned and k in left_out else text(k))) for k in ids.tolist()]
        docs = spark.createDataFrame(rows, DOCS).coalesce(2)
        out = score_documents(docs, F.col("doc_id") == 7, vocabulary=60, per=10, hidden=8, block_bytes=block_bytes).where("doc_id = 7").first()
        score.append((out.base_score, out.score))
    assert abs(score[0][0] - score[1][0]) < 1e-9
    assert abs(score[0][1] - score[1][1]) > 0.05


def test_a_lesson_has_its_last_symbol_and_each_document_one_round():
    import numpy as np

    from tramline.llm.gru import Model
    from tramline.llm.lm import taught

    ids, held = np.arange(-50, 5000, dtype=np.int64), np.arange(5050) % 7 == 2
    rounds = np.concatenate([taught(ids, held, turn, 4, 5) for turn in range(4)])
    assert sorted(rounds.tolist()) == np.flatnonzero(~held).tolist()
    flat = []
    for last in (1, 3):
        m = Model(np.array([9.0, 5, 4, 2, 1]), np.array([3.0, 1]), 2, 8, 0)
        seq = np.random.default_rng(0).integers(0, 7, 1003).astype(np.int32)
        seq[-1] = last
        m.train(seq, np.array([1003]), 0, 1, lanes=4, steps=8)
        flat.append(m.flat())
    assert np.abs(flat[0] - flat[1]).max() > 1e-6
