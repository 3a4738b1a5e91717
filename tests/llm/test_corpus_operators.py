"""Each corpus operator against a brute-force version on tables with every awkward row there is."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF, duck, rows

import corpus_pipeline
from geoquilt.llm import components, language, licenses, mixing, near_duplicates, near_vectors, nearest, packing, pii, prefixes, quality, queries, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long, node long, score double, kept boolean, hashes binary, words string, row string, at string, h string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts):
    """Documents with columns that the operators use for themselves."""
    made = [(i, t, "en", f"s{(i or 0) % 3}" if i != 5 else None, 0, 1, 0.5, True, b"x", "w", "r", "a", "h") for i, t in texts]
    return spark.createDataFrame(made, DOCS)


def awkward(n=40):
    random = np.random.default_rng(1)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [" ".join(random.choice(vocabulary, 60)) for _ in range(n)]
    out = [(i, t) for i, t in enumerate(base)]
    for k in range(12):  # near copies of one text, exact copies of another
        words = base[0].split()
        words[random.integers(60)] = f"new{k}"
        out.append((100 + k, " ".join(words)))
        out.append((200 + k, base[1].upper() if k % 2 else base[1]))
    out += [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "ONE"), (305, "one two"), (None, base[2]), (3, base[3]), (3, base[3])]
    out += [(400, "long " * 30000 + "end"), (401, "x" * 50000), (402, "no break   été \U0001f600 naïve")]
    return out


def shingle_set(text, k):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates(spark, words):
    texts = awkward()
    got = near_duplicates.near_duplicates(documents(spark, texts), near_duplicates.Forest(words=words)).collect()
    sets = [(i, shingle_set(t, words)) for i, t in texts]
    parent = {i: i for i, _ in texts if i is not None}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a is not None and b is not None and a < b and s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    wanted = sorted((repr(i), len(s), repr(top(i) if i is not None else None), i is not None and top(i) == i) for i, s in sets)
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.kept) for r in got) == wanted


def crowded(n=1500, pairs=60):
    """Documents that share a long passage and are each a little too different, and pairs of them just alike enough."""
    passage, out = [f"p{i}" for i in range(168)], []
    for i in range(n):  # 164 shingles in common of 164 + 2 * 32: 0.72
        out.append((i, " ".join(passage + [f"d{i}x{k}" for k in range(32)])))
    for i in range(pairs):  # 178 shingles in common of 178 + 2 * 18: 0.83
        out.append((n + i, " ".join(passage + [f"d{i}x{k}" for k in range(14)] + [f"e{i}x{k}" for k in range(18)])))
    return out


def test_near_duplicates_in_a_crowded_region(spark):
    n, pairs = 1500, 60
    rows_ = near_duplicates.near_duplicates(documents(spark, crowded(n, pairs))).collect()
    got = {r.doc_id: r.component_id for r in rows_}
    assert got == {i: i if i < n else i - n for i in range(n + pairs)}


def test_link_between_crowds(spark):
    """Two crowds that are a little too different, and one document that is near to one member of the second only."""
    passage = [f"p{i}" for i in range(168)]
    crowd = lambda side, i: " ".join(passage + [f"{side}{k}" for k in range(28)] + [f"{side}{i}x{k}" for k in range(4)])
    texts = [(base + i, crowd(side, i)) for base, side in ((0, "a"), (1000, "b")) for i in range(150)]
    texts.append((4000, " ".join(passage + [f"a{k}" for k in range(16)] + [f"b{k}" for k in range(16, 28)] + [f"b149x{k}" for k in range(4)])))
    sets = {i: shingle_set(t, 5) for i, t in texts}
    near = {i // 1000 for i, s in sets.items() if i != 4000 and 100 * len(s & sets[4000]) >= 80 * len(s | sets[4000])}
    got = {r.component_id for r in near_duplicates.near_duplicates(documents(spark, texts)).collect()}
    assert near == {0, 1}
    assert got == {0}


def test_empty_tables(spark):
    docs = documents(spark, [])
    path = queries.vocabulary("word_bpe_49k.json")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    weights = quality.fit(docs, labels)
    results = [
        near_duplicates.near_duplicates(docs), mixing.mix(docs), licenses.licenses(docs), near_vectors.near_vectors(vectors), nearest.top_k(vectors, vectors), packing.pack(tokens.pieces(docs, path, 0, 2048)),
        pii.find(docs), language.identify(docs, language.fit(docs)), quality.score(docs, weights, keep=["doc_id"]), tokens.prefix_counts(docs, queries.vocabulary("byte_bpe_50k.json")),
    ]
    assert [df.count() for df in results] == [0] * 10


def test_components(spark):
    random = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in random.integers(0, 400, (260, 2))] + [(1000, i) for i in range(1001, 1400)] + [(2000 + i, 2001 + i) for i in range(300)] + [(7777, 7777)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame([*links, *links[:5]], "u long, v long").repartition(6)).collect()}
    near = defaultdict(set)
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    wanted = {}
    for a in sorted(near):
        if a not in wanted:
            todo = [a]
            while todo:
                x = todo.pop()
                if x not in wanted:
                    wanted[x] = a
                    todo += near[x]
    assert got == wanted


def test_mixing(spark):
    texts = awkward()
    docs = documents(spark, texts)
    got, again = mixing.mix(docs), mixing.mix(docs.repartition(7))
    key = lambda df: sorted(repr(tuple(r)) for r in df.collect())
    assert key(got) == key(again)
    found = got.collect()
    assert sorted((repr(r.doc_id), r.size) for r in found) == sorted((repr(i), len(WORD.findall(t or ""))) for i, t in texts)
    by = defaultdict(lambda: [0, 0, 0.0, 0])
    for r in found:
        x = by[r.source]
        x[0], x[1], x[2], x[3] = x[0] + r.size, x[1] + r.taken, r.target, max(x[3], r.size)
        assert 0 <= r.taken <= 3 * r.size and r.source_size >= r.size
    assert sum(x[2] for x in by.values()) == pytest.approx(sum(x[0] for x in by.values()))
    assert all(abs(x[1] - x[2]) <= 2 * x[3] for x in by.values())


def test_targets_are_shared_again(spark):
    """Sources at three times their size give the rest to the others, by weight."""
    rows_ = spark.createDataFrame([("a", 1), ("b", 1000), ("c", 1000), (None, 10)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows_).collect()}
    assert got["a"] == 3 and got[None] == 30
    assert got["b"] == pytest.approx((2011 - 33) * 2 / 3) and got["c"] == pytest.approx((2011 - 33) / 3)


def test_packing(spark):
    texts = awkward()
    path, room = queries.vocabulary("word_bpe_49k.json"), packing.Room(tokens=128, pieces=5, cost=128 * 100)
    cut = tokens.pieces(documents(spark, texts), path, 0, 100)
    packed = packing.pack(cut, room).collect()
    encode = tokens.load(path)
    wanted = []
    for i, t in texts:
        ids = [*encode([t or ""])[0], 0]
        wanted += [(repr(i), k, s, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 100)) for p in [ids[s : s + 100]]]
    assert sorted((repr(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(wanted)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 128 and len(s) <= 5 and sum(n * n for _, n in s) <= 128 * 100


def test_best_fit_fills_sequences():
    random = np.random.default_rng(0)
    lengths = random.integers(1, 2049, 3000)
    bins = packing.best_fit(lengths, packing.Room())
    assert np.bincount(bins, lengths).max() <= 2048
    assert len(set(bins.tolist())) <= 1.01 * lengths.sum() / 2048 + np.sum(lengths > 1024) * 0.02 + 5


def test_token_counts(spark):
    path = queries.vocabulary("byte_bpe_50k.json")
    texts = [*awkward(), (500, "a <|endoftext|>b<|endoftext|> c"), (501, "  two  spaces\n\nlines   x\x1cy don't we'll "), (502, "(word), [x]: {y}! 'quoted' 3.14"), (503, "tab\t\tend\t"), (504, "你好世界"), (505, "a  b'll've''re\n\n x \x85\xa0\u3000 y"), (506, "supercalifragilistic"), (507, "   \n\t  ")]
    counted = tokens.prefix_counts(documents(spark, texts), path)
    encode = tokens.load(path)
    got = counted.collect()
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted((repr(i), len((t or "").encode()), len(encode([t or ""])[0])) for i, t in texts)
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 3)}
    for i, t in texts:  # every prefix, by itself
        if i in by and len(t or "") < 600:
            assert by[i].prefix_tokens == [len(x) for x in encode([t[: at + 1] for at in range(len(t or ""))])], i
    F = __import__("pyspark").sql.functions
    text = {i: t or "" for i, t in texts}
    for budget in (0, 1, 3, 10):
        for r in tokens.truncated(counted, budget).where("doc_id >= 300 and n_bytes < 600").withColumn("again", tokens.tokens_within(F.col("chars_within"))).collect():
            fits = [k for k in range(1, len(text[r.doc_id]) + 1) if len(encode([text[r.doc_id][:k]])[0]) <= budget]
            assert r.chars_within == max(fits, default=0) and r.again <= budget


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_single_words_are_encoded_alike(name):
    path = queries.vocabulary(name)
    quick, words = tokens.words_of(path), ["Straße", "ÉtÉ", "abc", "über", "Zx", "a", "supercalifragilistic"]
    if name.endswith(".model"):
        assert quick is None
    else:
        assert quick(words) == tokens.load(path)(words)


def test_near_vectors(spark):
    random = np.random.default_rng(2)
    base = random.standard_normal((30, 16))
    made = [(i, base[i].tolist(), i % 3) for i in range(30)]
    made += [(100 + k, (base[0] + random.standard_normal(16) * 0.03).tolist(), 0) for k in range(40)]
    made += [(200 + k, base[1].tolist(), 1) for k in range(5)] + [(300, (base[1] * 7).tolist(), 1), (301, base[1].tolist(), 2), (302, base[1].tolist(), None)]
    made += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [float("nan")] * 16, 0), (404, [float("inf")] + [0.0] * 15, 0), (405, [None] * 16, 0), (406, [1e-40] * 16, 0), (407, [1e-40] * 15 + [2e-40], 0), (408, base[0][:8].tolist(), 0), (5, made[5][1], made[5][2]), (None, base[0].tolist(), 0)]
    df = spark.createDataFrame([(*r, "x", 1) for r in made], "vec_id long, embedding array<double>, label int, node string, copies int")
    got = near_vectors.near_vectors(df, near_vectors.Codes(cell=16)).collect()

    def good(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def unit(v):
        v = np.array(v, float)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    links = defaultdict(list)
    for p, (a, v, l) in enumerate(made):
        for q, (b, w, m) in enumerate(made):
            if p != q and a is not None and b is not None and l is not None and l == m and good(v) and good(w) and len(v) == len(w) and unit(v) @ unit(w) >= 0.98:
                links[p].append(q)
    component = {}
    for p, (a, _, _) in enumerate(made):
        seen, todo = set(), [p]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += links[x] + [q for q, r in enumerate(made) if r[0] is not None and r[0] == made[x][0]]
        component[p] = min((made[x][0] for x in seen if made[x][0] is not None), default=None) if a is not None else None
    wanted = sorted((repr(r[0]), len(links[p]), repr(component[p])) for p, r in enumerate(made))
    assert sorted((repr(r.vec_id), r.n_links, repr(r.component_id)) for r in got) == wanted
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)


def test_top_k(spark):
    random = np.random.default_rng(4)
    made = [(i, random.standard_normal(12).round(2).tolist()) for i in range(300)] + [(300 + i, [0.5] * 12) for i in range(9)]
    made += [(400, None), (401, [float("nan")] * 12), (402, [None] * 12), (403, [1.0]), (404, [2.0]), (405, []), (None, [0.5] * 12), (7, [0.1] * 12), (500, [1e30] * 12)]
    df = spark.createDataFrame([(*r, 1, "s") for r in made], "vec_id long, embedding array<float>, rank int, score string")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in nearest.top_k(df, df.where("vec_id % 50 = 0 or vec_id = 403 or vec_id = 7"), k=5).collect()}
    valid = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v in made if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    ids = [i for i, _ in valid]
    for i, v in valid:
        if (i % 50 == 0 or i == 403) and ids.count(i) == 1:
            most = (1 << 63) - 1
            scored = sorted((-max(-most, min(most, sum(a * b for a, b in zip(v, w, strict=True)))), j) for j, w in valid if j != i and len(w) == len(v))[:5]
            assert [got.get((i, k + 1)) for k in range(len(scored))] == [(j, -s) for s, j in scored]


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(x) * (1 + i % 2) for i, x in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def personal(text):
    def valid(kind, value):
        digits = re.sub("[^0-9]", "", value)
        return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in value.split(".")), "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]

    return [(k, m.start(), m.end()) for k, p in KINDS.items() for m in re.finditer(p, text or "") if valid(k, m.group())]


def test_personal_data(spark):
    texts = awkward() + [
        (600, "a@b.c_x@y.z a@b@c.d .@-.- éa@b.co\U0001f600 e@f.gh mail: x.y+z@mail.example.com."),
        (601, "1.2.3.4.5 256.1.1.1 001.002.003.004 0255.1.1.1 1.2.3 99999999999.1.1.1 10.0.0.1"),
        (602, "4111 1111 1111 1111, 4111-1111-1111-1112 4111111111111111 00000000000000 card 378282246310005"),
        (603, "+1 (017) 555-7713 +123 +1 2 3 4 5 6 7 8 9 +44.20.7946.0958) +1+2 ++441234567890"),
        (604, "1" * 6000 + " " + "a." * 3000 + "@x.y " + "1.2." * 1500 + " a@" + "b." * 20000 + "c"),
        (605, "\x01\x02 a@b.co \x01x"), (606, "@ + . 5"), (607, "7 7-7 7 7-7"), (608, "x@y.z" * 50), (609, "+1 (017) 555-7713, 4111111111111111 and me@x.org on 10.1.2.3"),
    ]
    docs = documents(spark, texts)
    found = pii.find(docs)
    got = [(r.doc_id, r.text, [(pii.KINDS[x.kind], x.start, x.end) for x in r.pii_base], [(pii.KINDS[x.kind], x.start, x.end) for x in r.pii_spans]) for r in found.collect()]
    for i, text, base, spans in got:
        assert base == personal(text), i
        assert set(base) <= set(spans)
    cleaned = {r[0]: r[1] for r in found.where("doc_id >= 600").select("doc_id", pii.redacted(found)).collect()}
    assert cleaned[609] == "[phone], [card] and [email] on [ip]" and cleaned[606] == "@ + . 5"


def test_trees_add_what_the_base_misses(spark):
    """Values written in other ways, or announced by a word, are added; look-alikes are not, and base spans stay as they are."""
    random = np.random.default_rng(3)

    def card():
        digits = [4, *random.integers(0, 10, 14).tolist()]
        return next(f"{''.join(map(str, digits))}{d}" for d in range(10) if luhn([*digits, d]))

    texts = []
    for i in range(300):  # base spans and numbers of other sorts to learn from
        n = random.integers(1000, 9999)
        texts.append((i, f"nuso +1 (0{i % 90 + 10}) 555-{n} tave {card()} lomi p{i}@x{i % 7}.org rak {i % 200}.20.{i % 99}.7 ends"))
        texts.append((1000 + i, f"build {i % 5}.{i % 9}.{i % 7}.2 order {random.integers(10**15, 10**16)} on {i % 28 + 1}-12-1999 11 of {n} {n} units, id {random.integers(10**10, 10**11)}"))
    planted = {
        5000: ("ring 1 (017) 555-1000 now", [("phone", "1 (017) 555-1000")]), 5001: ("it is 4111.1111.1111.1111 here", [("card", "4111.1111.1111.1111")]), 5002: ("a b c 4111_1111_1111_1111", [("card", "4111_1111_1111_1111")]),
        5003: ("ask jo.doe (at) example.com", [("email", "jo.doe (at) example.com")]), 5004: ("at 10[.]1[.]2[.]3 then", [("ip", "10[.]1[.]2[.]3")]),
        5005: ("on 12-05-1999 10-11", []), 5006: ("sum 4111.1111.1111.1112", []), 5007: ("part 1,2,3,4", []), 5008: ("of 15095556973 items", []), 5009: ("user@1x2.3", []),
    }
    texts += [(i, t) for i, (t, _) in planted.items()]
    docs = documents(spark, texts)
    trees = pii.fit(pii.candidates(docs))
    assert 0 < len(trees.trees) <= pii.Boosting().trees and np.isfinite(trees.threshold)
    for r in pii.find(docs).where("doc_id >= 5000").collect():
        base = personal(r.text)
        spans = [(pii.KINDS[x.kind], x.start, x.end) for x in r.pii_spans]
        assert set(base) <= set(spans)
        assert [(k, r.text[a:b]) for k, a, b in spans if (k, a, b) not in base] == planted[r.doc_id][1], r.text


def test_licenses(spark):
    texts = awkward() + [
        (700, "Text before. Released under the MIT License. And Licensed under CC BY-NC 4.0."), (701, "released UNDER the mit license"), (702, "This work is licensed under the GNU General Public License, version 3."),
        (703, "licensed under the GNU General Public Licence version 3 only"), (704, "the MIT License"), (705, "Released under the MIT License. " * 400),
        (706, "It is licensed under the GNU General Public License, version 2."), (707, "This is licensed under the GNU Lesser General Public License, version 2.1 only."),
        (708, "You can redistribute it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or later."),
        (709, "Permission is hereby granted, free of charge, to any person getting a copy of this software and associated documentation files (the Software)"),
    ]
    docs = documents(spark, texts)
    got = licenses.licenses(docs).toPandas()
    c = duck()
    frame = docs.select("doc_id", "text").toPandas()
    c.register("given", frame)
    c.sql("create or replace temp view documents as select * from given")
    assert rows(got) == rows(c.sql(licenses.oracle()).df())
    assert {(r.doc_id, r.license) for r in got.itertuples()} >= {(700, "MIT"), (700, "CC-BY-NC-4.0"), (701, "MIT"), (702, "GPL-3.0"), (705, "MIT")}
    of = {d: {r.license for r in got.itertuples() if r.doc_id == d} for d in (702, 706, 707, 708)}
    assert of == {702: {"GPL-3.0"}, 706: {"GPL-2.0"}, 707: {"LGPL-2.1"}, 708: {"GPL-3.0"}}
    assert not {(704, "MIT"), (702, "AGPL-3.0")} & {(r.doc_id, r.license) for r in got.itertuples()}


def test_language_and_quality_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    found = queries.op8_language_id(spark, sf).toPandas()
    docs = duck(sf).sql("select doc_id, lang from documents").df()
    both = docs.merge(found, on="doc_id")
    held = both[both.held_out]
    assert len(held) > 200 and (held.lang == held.lang_pred).mean() > 0.97 and found.score.between(0, 1).all()
    scored = queries.op10_quality_classifier(spark, sf).toPandas()
    labels = duck(sf).sql("select doc_id, quality from labels").df().merge(scored, on="doc_id")
    held = labels[labels.held_out]
    assert (held.quality == held.predicted).mean() > 0.95 and scored.score.between(0, 1).all()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in scored.doc_id]).all()


def test_language_without_letters(spark):
    docs = documents(spark, awkward() + [(800, "123 !!"), (801, "你好"), (802, "İstanbul")])
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, language.fit(docs)).collect()}
    assert got[300] == got[301] == got[800] == ("und", 0.0) and got[801][0] == got[0][0] == "en"
    assert len(got) == len({i for i, _ in awkward()}) + 3


def test_quality_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    labels = spark.createDataFrame([(0, 1), (1, 0), (300, 1), (302, 0), (None, 1), (2, None), (400, 0), (3, 1), (3, 1)], "doc_id long, quality int")
    scored = quality.score(docs.drop("score"), quality.fit(docs, labels)).collect()
    assert len(scored) == len(awkward()) and all(0 <= r.quality_score <= 1 for r in scored)
    by = {r.doc_id: r.quality_score for r in scored}
    assert by[300] == by[301] == by[302]


def test_pipeline_stages(spark):
    """Each stage against what it must keep, on a whole small table."""
    c = duck()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.good_documents(spark, docs, SF)
    assert good.columns == docs.columns
    bad = {r[0] for r in c.sql("select doc_id from labels where quality = 0").fetchall()}
    kept = {r.doc_id for r in good.select("doc_id").collect()}
    assert len(kept & bad) <= 0.05 * len(bad) + 1 and len(kept) >= 0.8 * (docs.count() - len(bad))
    twice = good.unionByName(good.limit(3))
    one = corpus_pipeline.one_of_each_group(spark, twice, SF)
    ids = [r.doc_id for r in one.select("doc_id").collect()]
    texts = {r.doc_id: shingle_set(r.text, 5) for r in good.collect()}
    assert len(ids) == len(set(ids)) and set(ids) <= kept
    for a in ids:
        for b in ids:
            assert a >= b or not texts[a] or 100 * len(texts[a] & texts[b]) < 80 * len(texts[a] | texts[b])
    clean = corpus_pipeline.without_personal_data(spark, one, SF)
    assert clean.columns == docs.columns and not any(personal(r.text) for r in clean.collect() if "[" not in r.text)
    mixed = corpus_pipeline.mixed_sources(spark, clean, SF)
    assert mixed.columns == docs.columns
    times = mixing.mix(clean).where("times > 0").selectExpr("sum(times)").first()[0]
    assert mixed.count() == times
    packed = corpus_pipeline.packed_sequences(spark, mixed, SF).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    assert packed[packed.piece == 0].groupby("doc_id").size().sum() == times


def clashing(spark, texts):
    """Documents with columns of the names that stages use within."""
    names = ["quality_score", "score", "row", "text_2", "pii_row", "pii_base", "pii_spans", "pii_text", "mix_key", "key", "times", "turn", "kept", "component_id", "a.b", "quality_mark"]
    return documents(spark, texts).drop("score", "row", "kept").select("*", *[__import__("pyspark").sql.functions.lit(i).alias(n) for i, n in enumerate(names)])


def test_pipeline_stages_on_awkward_rows(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing names: what each stage keeps; empty tables stay empty."""
    texts = [*awkward(), (3, awkward()[3][1])]
    docs = clashing(spark, texts)
    n = len(texts)
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality", "near_dedup", "pii", "mix"):
        out = stages[name](spark, docs, SF)
        assert out.columns == docs.columns, name
        empty = stages[name](spark, docs.limit(0), SF)
        assert empty.columns == docs.columns and empty.count() == 0, name
        got = [tuple(r) for r in out.collect()]
        assert {r[3:] if name != "pii" else r[3:4] for r in got} <= {tuple(r)[3:] if name != "pii" else tuple(r)[3:4] for r in docs.collect()}
        if name == "near_dedup":
            ids = [r[0] for r in got if r[0] is not None]
            assert len(ids) == len(set(ids)) and {300, 301, 302} <= set(ids) and sum(r[0] is None for r in got) == 1
        if name == "pii":
            assert len(got) == n and sorted(map(repr, (r[0] for r in got))) == sorted(repr(i) for i, _ in texts)
    packed = stages["pack"](spark, docs, SF)
    assert packed.where("piece = 0").count() == n and stages["pack"](spark, docs.limit(0), SF).count() == 0


@pytest.mark.parametrize("partitions", [3, 17])
def test_near_duplicates_with_other_partitions(spark, partitions):
    """Links hang on no range of a sorted order: the same classes for other numbers of partitions, and small windows and cells."""
    random = np.random.default_rng(8)
    passage, texts = [f"p{i}" for i in range(120)], []
    for i in range(900):  # one crowd a little too different from each other, with all degrees of likeness in it
        texts.append((i, " ".join(passage + [f"d{i % 300}x{k}" for k in range(int(random.integers(6, 40)))] + [f"e{i}"])))
    sets = {i: shingle_set(t, 5) for i, t in texts}
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(documents(spark, texts), near_duplicates.Forest(window=4, cell=100)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {i: top(i) for i in sets}


def test_repeated_rows_of_fits(spark):
    """A row that is there many times over counts once for what is learned."""
    texts = [(i, f"wa{i} be co de fi{i % 3}") for i in range(60)]
    many = documents(spark, texts + texts[:5] * 50)
    once = documents(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    assert np.array_equal(quality.fit(once, labels), quality.fit(many, labels))
    a, b = language.fit(once), language.fit(many)
    assert np.allclose(a.weights, b.weights) and a.languages == b.languages


def test_set_digest_is_that_of_the_set():
    from geoquilt.llm import wordhash
    import pyarrow as pa

    a, b, c = wordhash.shingle_sets(pa.array(["x y z x y", "X Y z x y z x", "x y z y"]), 2)
    assert wordhash.digest(a) == wordhash.digest(b) != wordhash.digest(c) and hashlib and len(a) == 3


def test_stretches_have_the_ids_of_the_library():
    """Letters apart from punctuation, lowered first where nothing hangs on it: special strings, wide letters, contractions, odd spaces."""
    path = queries.vocabulary("word_bpe_49k.json")
    texts = ["It's CAFÉ’s ét", "ÀÉ, Foo!!bar", "a<|ENDOFTEXT|>b <|endoftext|>X", "Σίσυφος ΟΔΟΣ", "x\x85Y\xa0Z, İstanbul", "ABC123,d4 µ ª º"]
    texts += ["don't'LL we’ve abc'dEf", "word\x1cword, word\x1f", "a'SB, ['s'] L'ÉTÉ. ŉ ǅ", "foo.́bar ẞ", "ab—cd, Ȩ́, É,̧", "", " ", "Aa" * 200 + ",B"]
    found = tokens.Stretches(path, tokens.WITHOUT_SPACE, tokens.as_bytes)
    got = [b"".join(found.known[y] for y in x) for x in found.of(texts)]
    assert got == [np.array(x, "<u4").tobytes() for x in tokens.load(path)(texts)]


def test_prefix_counts_by_the_library_where_totals_differ(monkeypatch):
    counter = prefixes.PrefixCounter(queries.vocabulary("byte_bpe_50k.json"))
    texts = ["two words", "naïve 你好", "x", ""]
    wanted = counter.counts(texts)
    monkeypatch.setattr(counter, "one", lambda text: np.full(len(text), 99))
    assert counter.counts(texts) == wanted


def test_workers_of_the_pipeline_keep_few_stretches_and_the_same_ids(spark, monkeypatch):
    path, random = queries.vocabulary("word_bpe_49k.json"), np.random.default_rng(3)
    texts = [" ".join(f"w{k}" for k in random.integers(0, 3000, 50)) for _ in range(60)]
    few, many = (tokens.Stretches(path, tokens.WITHOUT_SPACE, tokens.as_bytes, kept) for kept in (200, tokens.KEPT))
    for at in range(0, 60, 4):
        found = few.of(texts[at : at + 4])
        assert len(few.known) + len(few.old) <= 2 * (200 // 2 + 4 * 50)
        assert [[few.known[x] for x in f] for f in found] == [[many.known[x] for x in f] for f in many.of(texts[at : at + 4])]
    assert len(many.known) > 1000
    asked = []
    monkeypatch.setattr(tokens, "pieces", lambda docs, *a, f=tokens.pieces, **b: asked.append(b["kept"]) or f(docs, *a, **b))
    docs = documents(spark, list(enumerate(texts)))
    assert corpus_pipeline.packed_sequences(spark, docs, SF).count() == 60 and max(asked) <= tokens.KEPT // 4


def test_token_counts_of_texts_cut_in_many_ways(spark):
    """Words, line breaks, punctuation, special strings and letters of several scripts in random order, against the library."""
    path = queries.vocabulary("byte_bpe_50k.json")
    bits = ["word", "Über", "ñandú", "x" * 90, "don't", "we'll", "'", "12", "3.5", ",", "...", "-", "<|endoftext|>", "<|end", "|>", "日本語", "ж", "é", "é", "😀", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", " ", "\x0b", "_", "{", "~", "×", "ª"]
    picks = np.random.default_rng(9)
    texts = ["".join(picks.choice(bits, picks.integers(1, 14))) for _ in range(1500)]
    encode = tokens.load(path)
    wanted = [len(x) for x in encode(texts)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counted = {r.doc_id: r for r in tokens.prefix_counts(docs, path).collect()}
    totals = {r.doc_id: r.n_tokens for r in tokens.token_counts(docs, path).collect()}
    assert [counted[i].n_tokens for i in range(len(texts))] == wanted == [totals[i] for i in range(len(texts))]
    for i in range(0, len(texts), 5):
        assert counted[i].prefix_tokens == [len(x) for x in encode([texts[i][: n + 1] for n in range(len(texts[i]))])], texts[i]
