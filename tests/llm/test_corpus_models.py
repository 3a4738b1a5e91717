"""Conversation repair, back-off scores and importance resampling against slow versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from conftest import SF, duck
from pyspark.sql import functions as F

from geoquilt.llm import common, conversations, importance, katz, language, licenses, mixing, near_duplicates, near_vectors, quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAME = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# Conversations


def damage(rows):
    """rows (conv, turn, role, text) as the damage leaves them, in order, by conversation."""
    out = {c: [] for c, *_ in rows}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return {conv: sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for conv, found in out.items()}


def cheapest(rows):
    """The counts and the repair of a conversation: all edit scripts, the cheapest and least first."""
    seen, faults = set(), []
    for _, role, text in rows:
        tail = WORD.findall(text)
        faults.append("blank" if not tail else "duplicate" if (role, text) in seen else "truncated" if tail[-1][-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(None)
    def best(i, state):  # state: what stands last, "" at the start
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        follows = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[follows]
        if inserts[-1] < 2:
            inserts.append(inserts[-1] + 1)
            cost, audit, lines = best_at(i, follows)
            inserts.pop()
            found.append((cost + 3, "I" + audit, (f"{name}:", *lines)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, audit, lines = best_at(i + 1, state, fresh=True)
            found.append((cost + 4, "D" + audit, lines))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] else 0
                if role[:1] == follows or (role[:1] == "s" and state == ""):
                    cost, audit, lines = best_at(i + 1, role[:1], fresh=True)
                    found.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                cost, audit, lines = best_at(i + 1, follows, fresh=True)
                found.append((cost + more + 3, "R" + audit, (f"{name}:{text}", *lines)))
        return min(found) if found else (10**9, "", ())

    inserts, memo = [0], {}

    def best_at(i, state, fresh=False):
        if fresh:
            inserts.append(0)
        key = (i, state, inserts[-1])
        if key not in memo:
            memo[key] = best.__wrapped__(i, state)
        if fresh:
            inserts.pop()
        return memo[key]

    cost, audit, lines = best_at(0, "")
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def talk(n=60, longest=14):
    random, rows = np.random.default_rng(5), []
    texts = ["Yes.", "no", "Why?", "", " \t", None, "été!", "Yes.", "it is so", "End. \n"] + [f"Text {i}." for i in range(12)]
    for conv in [*range(n), None]:
        for turn in range(int(random.integers(1, longest))):
            role = random.choice(["user", "assistant", "system", "tool", "", "useful"], p=[0.35, 0.35, 0.12, 0.06, 0.06, 0.06])
            rows.append((conv, None if random.random() < 0.05 else int(turn * 2 if random.random() < 0.2 else turn), None if random.random() < 0.03 else str(role), texts[random.integers(len(texts))]))
    return [*rows, rows[3], rows[3]]


def as_table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, n long, known string").repartition(3)


@pytest.mark.parametrize("chunk", [1, 3, 1 << 14])
def test_repair_equals_the_cheapest_of_all_scripts(spark, chunk):
    rows = talk()
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(as_table(spark, rows), chunk).collect()}
    assert got == {conv: cheapest(tuple(found)) for conv, found in damage(rows).items()}


def test_repair_of_one_long_conversation_and_of_none(spark):
    random = np.random.default_rng(3)
    rows = [(7, t, str(random.choice(["user", "assistant", "system"])), f"T{t % 200}{random.choice(['.', ''])}") for t in range(700)]
    whole = conversations.repair(as_table(spark, rows)).collect()
    cut = conversations.repair(as_table(spark, rows), 20).collect()
    assert whole == cut and len(whole) == 1
    found = damage(rows)[7]
    assert len(whole[0].audit.replace("I", "")) == len(found) and whole[0].cost > 0
    assert conversations.repair(as_table(spark, rows).where("false")).collect() == []


def test_rows_without_an_effect_on_costs_pass_through_many_chunks(spark):
    rows = [(1, t, "system", f"S{t}.") for t in range(60)]  # such rows never make two cost vectors alike
    got = [tuple(r)[1:] for r in conversations.repair(as_table(spark, rows), 4).collect()]
    assert got == [cheapest(tuple(damage(rows)[1]))]


# Back-off scores


def katz_slowly(texts, order, learned):
    rare = katz.RARE
    tokens = [["<"] * (order - 1) + [f"w{lower(w)}" for w in WORD.findall(t or "")] + [">"] for t in texts]
    tokens = [[lower(w) for w in t] for t in tokens]
    counts = [Counter() for _ in range(order + 1)]
    for t, known in zip(tokens, learned, strict=True):
        for m in range(1, order + 1):
            counts[m].update(tuple(t[i - m + 1 : i + 1]) for i in range(order - 1, len(t)) if known)
    discount = [None]
    for m in range(1, order + 1):
        n = [0] + [sum(c == r for c in counts[m].values()) for r in range(1, rare + 2)]
        of = {}
        for r in range(1, rare + 1):
            d, high = None, (rare + 1) * n[rare + 1] / n[1] if n[1] else 1
            if n[1] and n[r] and high != 1:
                d = ((r + 1) * n[r + 1] / n[r] / r - high) / (1 - high)
            of[r] = d if d is not None and 0 < d < 1 else (r - 0.5) / r
        discount.append(of)
    after = [defaultdict(dict) for _ in range(order + 1)]
    for m in range(1, order + 1):
        for g, c in counts[m].items():
            after[m][g[:-1]][g[-1]] = c

    @lru_cache(None)
    def p(word, before):
        m = len(before) + 1
        seen = after[m].get(before, {})
        total, kept = sum(seen.values()), sum(c * discount[m].get(c, 1.0) for c in seen.values())
        share = 1.0 if total - kept > 1e-12 else total / (total + 1.0)
        if word in seen:
            return share * seen[word] * discount[m].get(seen[word], 1.0) / total
        left = 1 - share * kept / max(1, total)
        if m == 1:
            return left
        return left / (1 - sum(p(w, before[1:]) for w in seen)) * p(word, before[1:]) if total else p(word, before[1:])

    n, kinds, out = sum(counts[1].values()), len(counts[1]), []
    for t in tokens:
        body = t[order - 1 :]
        base = sum(math.log10((counts[1][(w,)] + 1) / (n + kinds + 1)) for w in body)
        out.append((len(body), sum((w,) in counts[1] for w in body), n, base, sum(math.log10(p(t[i], tuple(t[i - order + 1 : i]))) for i in range(order - 1, len(t)))))
    for m in range(1, order + 1):  # normalised: all known words, the end and one unknown
        for before in list(after[m])[:20]:
            assert abs(sum(p(w, before) for w in [*(g[0] for g in counts[1]), "?"]) - 1) < 1e-9
    return out


def zipf_texts():
    random = np.random.default_rng(0)
    texts = [" ".join(f"w{min(int(x), 400)}" for x in random.zipf(1.4, int(random.integers(1, 60)))) for _ in range(150)]
    return [*texts, None, "", "  \t", "A a A a", "a a a a", *["the x1 the x2 the x3"] * 5, "y " * 500]


@pytest.mark.parametrize(("order", "size", "hot"), [(1, 1 << 20, 1000), (2, 1 << 20, 1000), (2, 40, 5), (3, 40, 5)])
def test_katz_scores(spark, order, size, hot):
    texts = zipf_texts()
    learned = [i % 4 != 2 for i in range(len(texts))]
    rows = [(i if i else None, t, known, 1, 0.5) for i, (t, known) in enumerate(zip(texts, learned, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, known boolean, slice long, score double").repartition(3)
    got = {r.doc_id or 0: r for r in katz.score(docs, F.col("known"), order, slice_tokens=size, hot_uses=hot).collect()}
    assert len(got) == len(texts)
    for i, (n_tokens, n_known, total, base, score) in enumerate(katz_slowly(texts, order, learned)):
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n_tokens, n_known, total)
        assert abs(got[i].base_score - base) < 1e-6 and abs(got[i].score - score) < 1e-6


def test_katz_of_repeated_rows_nothing_learned_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c")], "doc_id long, text string")
    assert katz.score(docs, F.lit(True)).count() == 3
    nothing = katz.score(docs, F.lit(None)).collect()
    assert [(r.score, r.base_score, r.n_known, r.train_tokens) for r in nothing] == [(0.0, 0.0, 0, 0)] * 3
    assert katz.score(docs.where("false"), F.lit(True)).collect() == []


def test_katz_query_beats_counts_without_context_on_held_out_texts(spark):
    rows = queries.op12_katz_scores(spark, SF).where("held_out").collect()
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


# Importance resampling


def features(text):
    words = NAME.findall(lower(text))
    return [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)], len(words)


def resampled_slowly(docs, target):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[0])
    for text in target:
        t.update(features(text)[0])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (all_s + 10000) / ((s[k] + 1) * (all_t + 10000)))) for k in range(10000)]
    rows = []
    for i, text in docs:
        found, n = features(text)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] for k in found)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((-r[3], r[0]) for r in rows if r[4] >= 20)
    place = {i: k + 1 for k, (_, i) in enumerate(able[: 5 * len(able) // 100])}
    return sorted((*r[:4], place.get(r[0])) for r in rows)


def test_importance_resampling_query(spark):
    docs = [tuple(r) for r in common.read(spark, SF, "documents").select("doc_id", "text").collect()]
    target = [r.text for r in common.read(spark, SF, "benchmark").select("text").collect()]
    assert sorted(tuple(r) for r in queries.op13_importance_resampling(spark, SF).collect()) == resampled_slowly(docs, target)


@pytest.mark.parametrize("sizes", [(0, 0), (3, 2), (1000, 1000)])
def test_features_are_the_same_with_any_head(spark, sizes):
    texts = ["Hello World, foo bar 12 été naïve x", "", None, "a b a b a b c the the the", "x" * 70000 + " y Z", "één \U0001f600 tést 7A-b", "a b"]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, buckets string, n long")
    head = importance.frequent(docs.select("doc_id", "text"), *sizes)
    assert len(head.words) <= sizes[0] and len(head.pairs) <= sizes[1]
    for r in importance.features(docs, head).collect():
        assert (sorted(np.frombuffer(bytes(r.buckets), np.uint16).tolist()), r.n_words) == (sorted(features(texts[r.doc_id])[0]), features(texts[r.doc_id])[1])


def test_resampling_of_awkward_tables(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(None, text), (3, text), (3, text), (4, None), (5, "short")] + [(10 + i, text + f" z{i}") for i in range(40)], "doc_id long, text string")
    target = spark.createDataFrame([("w1 w2 w3",), (None,)], "text string")
    got = importance.resample(docs, target, percent=50).collect()
    assert len(got) == 45 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 22))
    assert {r.doc_id: (r.weight, r["rank"]) for r in got if r.doc_id in (4,)} == {4: (0, None)}
    assert importance.resample(docs.where("false"), target).collect() == []
    assert all(r.n_features for r in importance.resample(docs.where("doc_id = 3"), target.where("false")).collect())


# Ids that stand for several rows; the queue of the mix replayed


def groups(n, linked):
    """For each of n rows the rows that links reach."""
    parent = list(range(n))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(n):
        for b in range(a):
            if linked(a, b):
                parent[max(top(a), top(b))] = min(top(a), top(b))
    return [top(x) for x in range(n)]


def test_an_id_of_several_vectors_loses_no_link(spark):
    random = np.random.default_rng(2)
    base = random.normal(size=(6, 16))
    rows = [(int(random.integers(0, 12)), 1, (base[k % 6] + 0.01 * random.normal(size=16)).tolist()) for k in range(40)] + [(5, 1, base[0].tolist()), (5, 1, base[1].tolist()), (6, 1, (base[0] * 2).tolist())]
    unit = np.array([v for *_, v in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.98
    of = groups(len(rows), lambda a, b: near[a, b])
    least = {g: min(rows[i][0] for i in range(len(rows)) if of[i] == g) for g in of}
    wanted = sorted((r[0], int(near[i].sum()) - 1, least[of[i]], r[0] == least[of[i]]) for i, r in enumerate(rows))
    got = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>").repartition(3)).collect()
    assert sorted(map(tuple, got)) == wanted


def test_an_id_of_several_texts_loses_no_link(spark):
    random = np.random.default_rng(4)
    base = [" ".join(random.choice([f"w{i}" for i in range(300)], 60)) for _ in range(6)]
    rows = [(int(random.integers(0, 12)), base[k % 6].replace(base[k % 6].split()[k], f"new{k}", 1)) for k in range(40)] + [(5, base[0]), (5, base[1]), (6, base[0] + " "), (3, None), (3, "")]

    def shingles(text):
        words = (text or "").split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    sets = [shingles(t) for _, t in rows]
    of = groups(len(rows), lambda a, b: bool(sets[a] and sets[b]) and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    least = {g: min(rows[i][0] for i in range(len(rows)) if of[i] == g) for g in of}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near_duplicates.near_duplicates(docs).collect()
    assert sorted(map(tuple, got)) == sorted((r[0], len(sets[i]), least[of[i]] if sets[i] else r[0], not sets[i] or r[0] == least[of[i]]) for i, r in enumerate(rows))
    stay = near_duplicates.one_of_each(docs).collect()
    kept = [(r.doc_id, next(g for g, s in zip(of, sets, strict=True) if s == shingles(r.text))) for r in stay if shingles(r.text)]
    assert sorted(kept) == sorted((least[g], g) for g in {of[i] for i in range(len(rows)) if sets[i]})
    assert sorted((r.doc_id, r.text or "-") for r in stay if not shingles(r.text)) == [(3, "-"), (3, "-")]


def mixed_slowly(rows, goals, turns):
    """Times that each document is taken: finish times of all passes in order, cut at the budget."""
    sizes, queue = Counter(), []
    for _, source, size in rows:
        sizes[source] += size
    for source, target in goals.items():
        so_far = 0
        for i, s, size in sorted((r for r in rows if r[1] == source), key=lambda r: (turns[r[0]], r[0])):
            so_far += size
            if target > 0:
                queue += [((so_far + k * sizes[s]) / target, turns[i], i, size) for k in range(3)]
    times, taken, budget = Counter(), 0, sum(sizes.values())
    for _, _, i, size in sorted(queue):
        taken += size
        if taken > budget:
            break
        times[i] += 1
    return times


@pytest.mark.parametrize("case", range(4))
def test_mix_equals_the_queue_replayed(spark, case):
    random = np.random.default_rng(case)
    if case == 0:  # small sources at their limits, one with a single large document, one of small documents
        rows = [(i, f"a{i}", 3) for i in range(10)] + [(100, "b", 5000)] + [(200 + i, "c", 1) for i in range(429)]
    else:
        rows = [(i, str(random.choice(["x", "y", "z", "q"], p=[0.7, 0.2, 0.07, 0.03])), int(random.integers(0, 50))) for i in range(200)]
    docs = spark.createDataFrame([(i, s, "w " * n) for i, s, n in rows], "doc_id long, source string, text string").repartition(3)
    turns = {r.doc_id: r.turn for r in docs.select("doc_id", F.xxhash64("doc_id", F.lit(17)).alias("turn")).collect()}
    got = mixing.mix(docs).collect()
    wanted = mixed_slowly(rows, {r.source: r.target for r in got}, turns)
    assert {r.doc_id: r.times for r in got if r.size} == {i: wanted[i] for i, _, n in rows if n}
    if case == 0:
        assert sum(r.taken for r in got) == sum(wanted[i] * n for i, _, n in rows)


# Licences


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("This is licensed under the GNU General Public License, version 2 of the year.", {"GPL-2.0"}),
        ("This is licensed under the GNU General Public License, version 3, so there.", {"GPL-3.0"}),
        ("This is licensed under the GNU General Public License, version 1, so there.", set()),
        ("This is licensed under the GNU General Public License, version 4, so there.", set()),
        ("It is licensed under the GNU Lesser General Public License, version 2 only.", set()),
        ("It is licensed under the GNU Lesser General Public License, version 2.1 only.", {"LGPL-2.1"}),
        ("It is licensed under the GNU Affero General Public License, version 1 only.", set()),
        ("Released under the BSD License by us.", {"BSD"}),
        ("It is licensed under Apache License 2.0 today.", {"Apache-2.0"}),
        ("Licensed under the Apache License, Version 1.1 long ago.", set()),
        ("We released under an MIT License all of it.", {"MIT"}),
    ],
)
def test_a_licence_is_named_with_its_version(spark, text, wanted):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert {r.license for r in licenses.licenses(docs).collect()} == wanted
    c = duck()
    c.execute("create temp table one as select 1 as doc_id, ? as text", [text])
    assert {r[1] for r in c.sql(licenses.oracle().replace("from documents", "from one")).fetchall()} == wanted


def made_up(letters: str, seed: int, n: int) -> list[str]:
    """Texts of words over some letters, with gaps of several sorts between them."""
    picks = np.random.default_rng(seed)
    word = lambda: "".join(picks.choice(list(letters), picks.integers(1, 7)))
    return ["".join(x for _ in range(picks.integers(1, 9)) for x in (word(), str(picks.choice([" ", ", ", " 7 ", ". ", "-"])))) for _ in range(n)]


def spectrum(text: str) -> set[str]:
    """Runs of one to three letters or gaps that hold a letter."""
    places = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    return {places[i : i + k] for k in (1, 2, 3) for i in range(len(places) - k + 1)} - {" ", "  ", "   "}


def test_language_equals_kernel_ridge_over_sets(spark):
    """Kernels of sets of n-grams and a regression by least squares, where every document is a landmark."""
    letters = {"xa": "aeioñtrs", "xb": "uybdgßkl", "xc": "aeubcfgh"}
    kinds = language._kinds()
    used = sorted(set("".join(letters.values())))
    assert len({kinds[ord(c)] for c in used}) == len(used)  # no two letters of the test are one kind
    rows = [(i * 3 + j, text, lang) for j, lang in enumerate(letters) for i, text in enumerate(made_up(letters[lang], j, 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    new = [(1000 + i, t) for i, t in enumerate([*made_up("aeioubñtßrs", 9, 30), "a", "!", "ß ñ", "QQQ"])]
    learner = language.Learner(landmarks=3 * 20)
    model = language.fit(docs, learner)
    found = {r.doc_id: r for r in language.identify(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}

    marks = [spectrum(text) for _, text, _ in rows]
    share = lambda a, b: len(a & b) / math.sqrt(max(1, len(a)) * max(1, len(b)))
    kernel = np.array([[share(a, b) for b in marks] for a in marks])
    names = sorted(letters)
    wanted = np.array([[1.0 if lang == name else -1.0 for name in names] for _, _, lang in rows])
    n, size = len(rows), len(rows) + 1
    penalty = np.zeros((size, size))
    penalty[:-1, :-1] = kernel
    root = np.linalg.cholesky(learner.ridge * n / size * penalty + 1e-8 * n * np.eye(size)).T
    stacked = np.concatenate([np.concatenate([kernel, np.ones((n, 1))], axis=1), root])
    weights = np.linalg.lstsq(stacked, np.concatenate([wanted, np.zeros((size, len(names)))]), rcond=None)[0]
    for doc_id, text in new:
        own = spectrum(text)
        if not own:
            assert (found[doc_id].lang_pred, found[doc_id].score) == ("und", 0.0)
            continue
        values = np.array([share(own, b) for b in marks] + [1.0]) @ weights
        top = np.sort(values)
        assert found[doc_id].score == pytest.approx(1 / (1 + math.exp(-4 * top[-1])), abs=2e-3), text
        if top[-1] - top[-2] > 2e-3:
            assert found[doc_id].lang_pred == names[int(values.argmax())], text


def word_features(text: str) -> dict[tuple, float]:
    """Shares of words, pairs of words, forms and pairs of forms, by name instead of by hash."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    low = [x.lower() for x in words]
    kind = lambda c: "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c
    forms = [(re.sub(r"(.)\1+", r"\1", "".join(map(kind, x))), i > 0 and low[i] == low[i - 1]) for i, x in enumerate(words)]
    out = {}
    for sort, seen in enumerate((low, list(zip(low, low[1:], strict=False)), forms, list(zip(forms, forms[1:], strict=False)))):
        out |= {(sort, x): k / len(seen) for x, k in Counter(seen).items()}
    return out


def test_quality_equals_regression_by_named_features(spark):
    """Follow-the-regularised-leader one example and one feature at a time, in dictionaries."""
    picks = np.random.default_rng(4)
    good, bad = ["river", "Stone", "green", "walks", "7", "far"], ["BUY", "buy", "now!!", "$$$", "win", "far"]
    texts = [" ".join(picks.choice(good if i % 2 else bad, picks.integers(0, 9))) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    learner = quality.Learner()
    found = {r.doc_id: r.quality_score for r in quality.score(docs, quality.fit(docs, labels, learner), learner).collect()}

    order = [r.id for r in spark.range(40).orderBy(F.xxhash64("id"), "id").collect()]
    examples = [({key: v * learner.scale for key, v in word_features(texts[i]).items()} | {"constant": 1.0}, i % 2) for i in order]
    z, n = defaultdict(float), defaultdict(float)

    def weight(key):
        if abs(z[key]) <= learner.l1:
            return 0.0
        return -(z[key] - math.copysign(learner.l1, z[key])) / ((learner.beta + math.sqrt(n[key])) / learner.alpha + learner.l2)

    chance = lambda values: 1 / (1 + math.exp(-sum(weight(key) * v for key, v in values.items())))
    for epoch in range(learner.epochs):
        for i in np.random.default_rng(epoch).permutation(len(examples)):
            values, label = examples[i]
            off = chance(values) - label
            for key, v in values.items():
                gradient, w = off * v, weight(key)
                z[key] += gradient - (math.sqrt(n[key] + gradient**2) - math.sqrt(n[key])) / learner.alpha * w
                n[key] += gradient**2
    for i, text in enumerate(texts):
        values = {key: v * learner.scale for key, v in word_features(text).items()} | {"constant": 1.0}
        assert found[i] == pytest.approx(chance(values), abs=1e-4), text
