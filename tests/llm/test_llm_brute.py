"""Operators against plain sequential versions, on small fixtures with nulls, empty and long texts, ties and repeats."""

import hashlib
import re
import textwrap
import zlib
from collections import defaultdict

import pytest

pytest.importorskip("tramline.llm")

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, th int, key string"
BASE = "The quick brown fox jumps over the lazy dog while seven wizards brew a potion of honey and salt near the old mill"


def table(spark, rows):
    """Documents with extra columns whose names clash with those that the operators use."""
    return spark.createDataFrame([(i, t, None, "src", len(t or ""), "x", 1, "k") for i, t in rows], SCHEMA)


ODD = [
    (5, None), (3, ""), (9, "  \t\n"), (1, "one two"), (2, "one  two"), (2, "one  two"), (None, "one two"), (7, BASE), (8, BASE + " again"),
    (10, BASE.replace(" ", "\n ")), (11, "word " * 3000), (12, "x" * 50_000), (13, "é ü ñ 漢字 \x85z"), (2, "another text with the same id"),
]


def real(spark, n=200):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(n).collect()]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_directory_doubles_without_a_cap(spark):
    """Keys crowded into a small range: buckets there split until they fit, and every key finds its own through the cells."""
    from tramline.llm.exact_dedup import directory

    keys = [(k - 20) * (1 << 58) // 10 for k in range(40)]
    found = directory(spark.createDataFrame([(k,) for k in keys], "key long"), 4).collect()
    (bits,) = {r.bits for r in found}
    by_cell = {r.cell: (r.bucket, r.depth) for r in found}
    held = defaultdict(int)
    for k in keys:
        held[by_cell[(k % 2**64) >> (64 - bits)]] += 1
    assert bits > 0 and max(held.values()) <= 4 and max(d for _, d in held) == bits
    few = directory(spark.createDataFrame([(1,), (2,)], "key long"), 4).collect()
    assert [(r.cell, r.bits, r.bucket) for r in few] == [(0, 0, 0)]


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_dedup(spark, bits):
    from tramline.llm.exact_dedup import digest, exact_dedup

    rows = ODD + [(100 + i, f"t{i % 7}  x") for i in range(60)] + [(2**63 - 1, "the last id"), (2**63 - 1, "t1 x")]
    found = sorted((tuple(r) for r in digest(exact_dedup(table(spark, rows), capacity=4, key_bits=bits)).collect()), key=str)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    by = defaultdict(list)
    for i, t in rows:
        by[norm(t)].append(i)
    want = []
    for i, t in rows:
        ids = by[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        want.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    assert found == sorted(want, key=str)
    assert exact_dedup(table(spark, [])).count() == 0


def test_ngram_join(spark):
    from tramline.llm.ngram_join import near_duplicates, one_of_each

    rows = ODD + [(200 + i, BASE + " " + " ".join(f"w{j}" for j in range(i))) for i in range(8)] + [(1000 + i, t) for i, t in real(spark)]
    for block in (400_000, 60):
        found = [tuple(r)[:4] for r in near_duplicates(table(spark, rows), block=block).collect()]
        sets = []
        for _, t in rows:
            w = words(t)
            sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
        links = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(len(rows))]
        label = list(range(len(rows)))
        for _ in rows:
            label = [min([label[i]] + [label[j] for j in links[i]]) for i in range(len(rows))]
        least = lambda ids: min((x for x in ids if x is not None), default=None)
        want = []
        for i, (d, _) in enumerate(rows):
            cls = least(rows[j][0] for j in range(len(rows)) if label[j] == label[i]) if sets[i] else d
            txt = least(rows[j][0] for j in range(len(rows)) if sets[j] == sets[i]) if sets[i] else d
            want.append((d, cls, txt, len(links[i])))
        assert sorted(found, key=str) == sorted(want, key=str)
    assert near_duplicates(table(spark, [])).count() == 0
    kept = {r.doc_id for r in one_of_each(table(spark, rows)).collect()}
    assert {5, 3, 9, 7, 12} <= kept and not {10, 201} & kept


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tramline.llm.packing import digest, pack

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = ODD + [(30, "a <|endoftext|> b<|startoftext|>c don't WE'LL Ünïcode é ́x"), (31, "Σίσυφος ΣΑΣ ﬁ ① K")] + [(1000 + i, t) for i, t in real(spark)]
    out = pack(table(spark, rows), path).collect()
    tok = Tokenizer.from_file(path)
    want = [(i, bytes(b"".join(x.to_bytes(4, "little") for x in [*tok.encode(t or "", add_special_tokens=False).ids, 1]))) for i, t in rows]
    pieces = [(i, s // 4, b[s : s + 8192], len(b) // 4) for i, b in want for s in range(0, len(b), 8192)]
    assert sorted((str(r.doc_id), r.start, bytes(r.ids), r.doc_tokens) for r in out) == sorted((str(i), s, b, n) for i, s, b, n in pieces)
    by = defaultdict(list)
    for r in out:
        assert len(r.ids) == 4 * r.length
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= 2048
    total = sum(r.length for r in out)
    assert len(by) <= 1.02 * total / 2048 + 1
    assert {r.ids_crc32 for r in digest(pack(table(spark, rows[:3]), path)).collect()} == {zlib.crc32((1).to_bytes(4, "little"))}
    assert pack(table(spark, []), path).count() == 0


def brute_spans(t):
    t = t or ""
    out = []
    digits = lambda m: re.sub("[^0-9]", "", m)

    def luhn(d):
        return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0

    for k, (pattern, ok) in enumerate(
        [
            (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
            (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
            (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
        ]
    ):
        out += [(m.start(), k, m.end()) for m in re.finditer(pattern, t) if ok(m[0])]
    return sorted(out)


def test_pii(spark):
    from tramline.llm.pii import KINDS, digest, find_personal_data, sanitised

    odd = [
        "a@b.com_x@y.org, a@b.co.x@y.com a@b-c@d.com a@@b.c a@b..c x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 0000255.1.1.1 1.2.3", "4111 1111 1111 1111 4111-1111--1111-1111 5 4111111111111111x 41111111111111112 12 34 4111111111111111",
        "+1 (555) 555-0100 + 1 +1 2 +12345678901234567890 +49.30.1234567)", "é漢 漢字@例.com ü a.b@c.de\n4111111111111111 10.0.0.1", "1 " * 4000 + "9" * 5000, "." * 3000 + "@" * 2000, "+1" * 3000, "a" * 40_000,
    ]
    secret = [(500 + i, f"Some words here zebulon{'' if i < 4 else i} wrote from bob@example.com today the end") for i in range(5)]
    rows = ODD + list(enumerate(odd, 20)) + secret + [(1000 + i, t) for i, t in real(spark)]
    out = digest(find_personal_data(table(spark, rows))).collect()
    want = []
    for i, t in rows:
        s = brute_spans(t)
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in s)
        want.append((str(i), *[sum(x[1] == k for x in s) for k in range(4)], hashlib.sha256(text.encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in out) == sorted(want)
    for r in out:
        base = [x for x in r.spans.split(",") if x and not x.startswith("term")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256
    spans = {r.doc_id: r.spans for r in out}
    t = secret[0][1]
    assert f"term:{t.index('zebulon')}:{t.index('zebulon') + 7}" in spans[500] and "term" not in spans[7]
    clean = {r.doc_id: r.text for r in sanitised(table(spark, rows)).collect()}
    assert "bob@" not in clean[501] and "zebulon " not in clean[501] and clean[7] == BASE and clean[5] is None
    assert find_personal_data(table(spark, [])).count() == 0


def test_toxicity(spark):
    import math

    from tramline.llm.toxicity import Lexicon, fold, learn, score_toxicity, without_toxic

    assert fold("Lоѕer! 1d10t") == fold("loser idiot") == " ioser idiot "
    lex = Lexicon({" idiot ": 5.0}, [" idiot proof "], [0, 1, 0, 0])
    assert lex.features("You Ιd1οt")[0] == 5.0 and lex.features("idiot-proof idiot")[0] == 5.0 and lex.features("")[0] == 0.0
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    lexicon = learn(docs, labels, min_support=4)
    assert lexicon.weights

    def naive(text):
        """Every entry tried at every place of the folded text."""
        folded = fold(text)
        places = lambda e: [k for k in range(len(folded)) if folded.startswith(e, k)]
        best = {}
        for e, w in lexicon.weights.items():
            for k in places(e):
                best[k] = max(best.get(k, 0.0), w)
        spared = {k for e in lexicon.exceptions for at in places(e) for k in range(at, at + len(e))}
        hits = [w for k, w in best.items() if k not in spared and w > 0]
        n = max(1, len(folded.split()))
        a, b, c = sum(hits), sum(hits) / n, len(hits) / n
        z = sum(x * y for x, y in zip((1, math.log1p(a), math.log1p(100 * b), 100 * c), lexicon.curve, strict=True))
        return 1 / (1 + math.exp(-max(-40, min(40, z))))

    got = {r.doc_id: r for r in score_toxicity(docs, labels, min_support=4).collect()}
    assert len(got) == docs.count()
    for r in docs.where("length(text) < 3000").limit(60).collect() + docs.join(labels.where("toxic = 1"), "doc_id").where("length(text) < 3000").limit(40).collect():
        assert abs(got[r.doc_id].score - naive(r.text)) < 1e-9 and got[r.doc_id].predicted == (got[r.doc_id].score >= 0.5)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    none = table(spark, [])
    assert score_toxicity(none, labels).count() == 0
    assert {r.score < 0.01 for r in score_toxicity(table(spark, ODD), labels.limit(0)).collect()} == {True}
    assert without_toxic(table(spark, ODD), labels).count() == len(ODD)


def test_factors():
    """The greedy parse finds each window that a reference block has, and its factors are as long as words agree."""
    import random

    from tramline.llm.substring_dedup import Reference

    rng = random.Random(1)
    for _ in range(300):
        refs = [[rng.choice("abc") for _ in range(rng.randint(3, 20))] for _ in range(rng.randint(0, 4))]
        text = [rng.choice("abc") for _ in range(rng.randint(3, 25))]
        reference = Reference(3)
        for r in refs:
            reference.add(" ".join(r).encode())
        found = reference.factors(" ".join(text).encode())
        covered = {k + i for k, size in found for i in range(size - 2)}
        assert covered == {k for k in range(len(text) - 2) if any(text[k : k + 3] == r[j : j + 3] for r in refs for j in range(len(r) - 2))}
        assert all(any(text[k : k + size] == r[j : j + size] for r in refs for j in range(len(r))) for k, size in found)


@pytest.mark.parametrize(("window", "anchor", "most"), [(50, 10, 4_000), (6, 2, 4_000), (6, 2, 3)])
def test_substring_dedup(spark, window, anchor, most):
    from tramline.llm.substring_dedup import digest, without_repeats

    rows = ODD + [(1000 + i, t) for i, t in real(spark)] + [(400 + i, "start " * (i % 3) + BASE + " x" * i + " " + BASE[10 * i :]) for i in range(12)] + [(390, "a b c " * 80), (391, "b c a " * 70)]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in digest(without_repeats(table(spark, rows), window, anchor, most)).collect())
    first = {}
    big = 2**63 - 1
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            first[key] = min(first.get(key, big), big if i is None else i)
    want = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < (big if i is None else i):
                gone.update(range(k, k + window))
        stay = [x for k, x in enumerate(w) if k not in gone]
        want.append((str(i), len(w), len(gone), hashlib.sha256(" ".join(stay).encode()).hexdigest()))
    assert got == sorted(want)
    assert sum(r[2] > 0 for r in want) > 5
    assert without_repeats(table(spark, [])).count() == 0


def test_lm_scoring(spark):
    import math
    from collections import Counter

    from pyspark.sql import functions as F

    from tramline.llm.lm import score_documents

    rows = ODD + [(1000 + i, t) for i, t in real(spark)]
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    out = score_documents(table(spark, rows), held, vocabulary=200, per=20, hidden=16, block_bytes=60_000, part_types=500).collect()
    toks = [(i, [*("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words(t)), "\n"]) for i, t in rows]
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in toks if not is_held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), is_held(i), len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 4)) for i, t in toks)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == want
    mine = [r for r in out if r.held_out]
    assert sum(r.score for r in mine) > sum(r.base_score for r in mine)
    assert all(r.score < 0 for r in out)
    assert score_documents(table(spark, []), held).count() == 0
    assert len(score_documents(table(spark, [(1, None)]), F.lit(True)).collect()) == 1


def test_model_is_a_distribution():
    import numpy as np

    from tramline.llm.gru import Model

    m = Model(np.array([9.0, 5, 4, 2, 1]), np.array([3.0, 1]), 2, 8, 0)
    rng = np.random.default_rng(0)
    seq, sizes = rng.integers(0, 7, 900).astype(np.int32), np.array([300, 1, 0, 599])
    m.train(seq, sizes, 0, 1, lanes=4, steps=8)
    h = rng.standard_normal((1, 8)).astype(np.float32)
    assert abs(np.exp([m.log_probabilities(h, np.array([y]))[0] for y in range(7)]).sum() - 1) < 1e-5
    # Windows and lanes change nothing: the state is carried through the whole document.
    one = m.score(seq, sizes, 0, lanes=1, steps=1000)
    assert np.allclose(one, m.score(seq, sizes, 0, lanes=3, steps=7), rtol=1e-4) and one[2] == 0


def test_nearest_neighbours(spark):
    import numpy as np

    from tramline.llm.ann import nearest_neighbours

    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 24))
    x[700:760] = x[700]
    rows = [(i, [float(v) for v in r], 1, 2) for i, r in enumerate(x)]
    rows += [(2000, None, 1, 1), (2100, [0.0] * 24, 1, 1), (2200, [float("nan")] * 24, 1, 1), (2300, [None] * 24, 1, 1), (2400, [1.0, 2.0], 1, 1), (2401, [1.0, 2.5], 1, 1), (None, [1.0] * 24, 1, 1), (3000, [5.0, 5.0, 5.0], 1, 1), (3000, [5.0, 5.0, 5.0], 2, 2), (3000, [5.0, 5.0, 7.0], 1, 1), (3001, [5.0, 5.0, 6.0], 1, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int, id int")
    got = defaultdict(list)
    for r in nearest_neighbours(df, rows_a_block=300, queries_a_block=4).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id]) or r.query_id == 3000
    # Each of three rows that share a vec_id asks, and meets the other two.
    assert sorted(got.pop(3000)) == sorted([(3000, 0.0), (3001, 1.0), (3000, 2.0)] * 2 + [(3001, 1.0), (3000, 2.0), (3000, 2.0)])
    assert [v for v, _ in got.pop(2400)] == [2401]
    assert sorted(got) == list(range(0, 1500, 100))
    hit = 0
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(len(x)), d))[:10].tolist()
        hit += len({v for v, _ in found} & set(want))
        assert len(found) == 10 and all(abs(s - d[v]) < 1e-9 for v, s in found) and found == sorted(found, key=lambda f: (f[1], f[0]))
        if q == 700:
            assert [v for v, _ in found] == list(range(701, 711))
    assert hit >= 0.9 * 10 * len(got)
    few = nearest_neighbours(df.where("vec_id < 4")).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(0, 1), (0, 2), (0, 3)]
    assert nearest_neighbours(df.limit(0)).count() == 0


def test_licences(spark):
    from tramline.llm.licences import TEMPLATES, bigrams, scan_licences

    mit = TEMPLATES["MIT"]
    rows = ODD + [(40, f"Intro text of a page.\n{mit[:200]}\n{mit[200:]}\nAnd more of it."), (41, "x\nReleased under the MIT License.\ny\nLicensed under CC BY-NC 4.0."), (42, "licensed, under: the MIT license"), (43, TEMPLATES["BSD-3-Clause"]), (44, "MIT")]
    got = {r.doc_id: r for r in scan_licences(table(spark, rows)).collect() if r.doc_id is not None}
    assert got[40].licence == "MIT" and got[40].dice > 0.95
    assert [m.licence for m in got[41].matches] == ["MIT notice", "CC-BY-NC-4.0 notice"] and got[41].matches[0].start == 2
    assert got[42].licence == "MIT notice (licensed)" and got[43].licence == "BSD-3-Clause" and got[44].licence is None
    assert all(got[i].licence is None for i in (1, 3, 5, 7, 9, 11, 12))
    # A notice inside a longer line, a wrapped one next to prose, and whole licences.
    line = "All code samples on this page are Licensed under the Apache License, Version 2.0. Have fun in the end"
    prose = "In the end, all of the people of the town came to the old mill"
    wrapped = "\n".join([prose, *textwrap.wrap(mit, 61), prose])
    rows = [(1, line), (2, wrapped), (3, prose), (4, "x. " * 9 + TEMPLATES["ISC"] + " y" * 9), (5, " ".join(["Released under the MIT License."] * 300))]
    got = {r.doc_id: r for r in scan_licences(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].licence == "Apache-2.0 notice" and line[got[1].matches[0].start : got[1].matches[0].end] == "Licensed under the Apache License, Version 2.0"
    assert got[2].licence == "MIT" and got[2].dice > 0.9 and got[3].licence is None and got[4].licence == "ISC" and got[4].dice == 1.0
    assert got[5].n_matches == 300
    assert scan_licences(table(spark, [])).count() == 0
    # Both ways: a text has a match where, and only where, some line, run, whole text or window of words reaches 0.9.
    word = re.compile(r"[^\W_]+(?:\.[0-9]+)*")
    sets = [bigrams(word.findall(x.lower())) for x in TEMPLATES.values()]
    some = [(i, t) for i, t in real(spark) if len(t or "") < 2500]
    mine = {r.doc_id: r.dice for r in scan_licences(spark.createDataFrame(some, "doc_id long, text string")).collect()}
    for i, t in some:
        w = word.findall((t or "").lower())
        lines = [word.findall(x.lower()) for x in (t or "").split("\n")]
        units = [x for x in [*lines, w] if x]
        for s in sets:
            units += [w[k : k + len(s) + 1] for k in range(len(w) - len(s))] if len(s) < 12 else []
        best = max((2 * len(g & s) / (len(g) + len(s)) for u in units for g in [bigrams(u)] for s in sets if 0.8 * len(s) < len(g) < 1.25 * len(s)), default=0)
        assert best < 0.9 or mine[i] >= best - 1e-12, (i, best, mine[i])
        assert mine[i] is None or best >= 0.9, (i, best, mine[i])


def test_pieces(spark):
    import numpy as np
    import public_tokenizers

    from tramline.llm.pieces import decode, digest, encode, pieces

    path = public_tokenizers.path("piece_bpe_32k.model")
    p = pieces(path)
    rows = ODD + [(50, "▁▁x ▁ \r\n  \x00 😀  "), (51, " " * 9), (52, "ab" * 9000)] + [(1000 + i, t) for i, t in real(spark, 30)]
    out = digest(decode(encode(table(spark, rows), path), path)).collect()
    assert len(out) == len(rows) and all(r.exact for r in out)
    assert sorted(r.decoded_sha256 for r in out) == sorted(hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows)

    def best(t):
        t, n = " " + t, len(t) + 1
        score = [0.0] + [-np.inf] * n
        for i in range(1, n + 1):
            for k in range(max(0, i - p.reach), i):
                hit = p.ids.get(t[k:i])
                score[i] = max(score[i], score[k] + (hit[0] if hit else p.fallback if k == i - 1 else -np.inf))
        return score[n]

    by_id = {i: (piece, s) for piece, (s, i) in p.ids.items()}
    for _, t in rows[-12:]:
        t = t[:1500]
        ids = np.frombuffer(p.encode(t), "<u4").tolist()
        given = list(p.stream(t[k : k + 7] if k else " " + t[:7] for k in range(0, len(t), 7)))
        assert [i for x in given for i in x] == ids and len(given) > len(t) // 60
        assert b"".join(p.out[i] for i in ids).decode()[1:] == t
        if all(i in by_id for i in ids):
            assert sum(by_id[i][1] for i in ids) == best(t)
