"""Decontamination, Jaccard components, substring dedup, language-model scores
and mixing against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import components, contamination, jaccard, lm, mixing, repeats

WORD = re.compile("[^\x20\x09-\x0d]+")
ITEM_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(t):
    return WORD.findall(t or "")


def test_components_are_the_smallest_reachable(session):
    rng = random.Random(0)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    got = {r.node: r.component for r in components.components(session.createDataFrame(edges, "u long, v long")).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for u, v in edges:
        if u != v:
            a, b = sorted((find(u), find(v)))
            parent[b] = a
    assert got == {x: find(x) for x in parent}


def _contaminated(docs, items):
    split = lambda t: ITEM_WORD.findall((t or "").translate(LOWER))
    runs = defaultdict(set)
    for item, t in items:
        w = split(t)
        for i in range(max(1, len(w) - 9)):
            if w:
                runs[tuple(w[i : i + 10])].add(item)
    out = Counter()
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for run, who in runs.items():
            for i in range(len(w) - len(run) + 1):
                if tuple(w[i : i + len(run)]) == run:
                    hit.update(range(i, i + len(run)))
                    found |= who
        out[(d, len(w), len(hit), tuple(sorted(map(str, found))))] += 1
    return out


@pytest.mark.parametrize("bound", [64 << 20, 300])
def test_contamination(session, docs, corpus, empty, bound):
    rng = random.Random(9)
    texts = [t for _, t in corpus if t and len(words(t)) > 40]
    items = [(i, " ".join(words(rng.choice(texts))[5 : 5 + rng.randrange(3, 30)]).upper()) for i in range(25)]
    items += [(100, None), (101, ""), (102, "one two"), (103, items[0][1]), (104, "ÉA É"), (105, "absent words only here today friends and more of them")]
    bench = session.createDataFrame(items, "item_id long, text string")
    plain = [(d, (t or "")) for d, t in corpus]
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in contamination.contamination(docs, bench, broadcast_bytes=bound).collect())
    assert got == _contaminated(plain, items)
    if bound > 300:
        assert contamination.contamination(empty, bench).count() == 0
        none = contamination.contamination(docs, bench.limit(0))
        assert none.where("n_hit > 0").count() == 0 and none.count() == len(corpus)


def _shingles(t):
    w = words((t or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def _groups(docs):
    sets = [(d, _shingles(t)) for d, t in docs]
    parent = list(range(len(sets)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


@pytest.mark.parametrize("keys", [4_000_000, 500])
def test_jaccard_components(session, docs, corpus, empty, keys):
    got = Counter(tuple(r) for r in jaccard.jaccard_components(docs, fragment_keys=keys).collect())
    assert got == _groups(corpus)
    if keys > 500:
        assert jaccard.jaccard_components(empty).count() == 0


def test_jaccard_chains_and_borders(session):
    rng = random.Random(4)
    rows, base = [], [f"t{i}" for i in range(60)]
    for i in range(120):  # a drifting chain: neighbours link, ends do not
        base = list(base)
        for _ in range(rng.randrange(0, 2)):
            base[rng.randrange(60)] = f"n{i}"
        rows.append((1000 - i, " ".join(base[: 60 - rng.randrange(0, 4)])))
    df = session.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in jaccard.jaccard_components(df).collect()) == _groups(rows)


def _dedup(docs, k):
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - k + 1):
            run = tuple(w[i : i + k])
            first[run] = min(first.get(run, d), d)
    out = Counter()
    for d, t in docs:
        w, gone = words(t), set()
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < d:
                gone.update(range(i, i + k))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[(d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    return out


@pytest.mark.parametrize("length,most,task", [(50, 50_000, 100_000), (50, 1, 3), (12, 2, 5)])
def test_repeated_spans(session, docs, corpus, empty, length, most, task):
    got = repeats.repeated_spans(docs, length, group_segments=most, task_segments=task).drop("spans")
    assert Counter(tuple(r) for r in got.collect()) == _dedup(corpus, length)
    if task > 5:
        assert repeats.repeated_spans(empty).count() == 0
        odd = session.createDataFrame([(None, " ".join(f"w{i}" for i in range(80)))] * 2, "doc_id long, text string")
        assert [r.n_removed for r in repeats.repeated_spans(odd).collect()] == [0, 0]


def test_repeats_of_single_words_and_self_overlap(session):
    rows = [(3, "a " * 200), (1, "a " * 60), (2, "b " * 49), (7, "b " * 49 + "c"), (9, "b " * 51), (8, "b " * 50)]
    df = session.createDataFrame(rows, "doc_id long, text string")
    assert Counter(tuple(r) for r in repeats.repeated_spans(df).drop("spans").collect()) == _dedup(rows, 50)


def _model(docs):
    train = [(d, words((t or "").translate(LOWER))) for d, t in docs if zlib.crc32(str(d).encode()) % 7 != 2]
    uni = Counter(x for _, w in train for x in [*w, None])
    return sum(uni.values()), len(uni), uni


def test_lm_base_scores(session, docs, corpus, empty):
    got = {(r.doc_id, r.n_tokens): r for r in lm.score_texts(docs, bucket_keys=700).collect()}
    total, distinct, uni = _model(corpus)
    for d, t in corpus:
        tokens = [*words((t or "").translate(LOWER)), None]
        r = got[(d, len(tokens))]
        base = sum(math.log10((uni[x] + 1) / (total + distinct + 1)) for x in tokens)
        assert r.train_tokens == total and r.held_out == (zlib.crc32(str(d).encode()) % 7 == 2)
        assert r.n_known == sum(uni[x] > 0 for x in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
    assert lm.score_texts(empty).count() == 0


def test_lm_probabilities_sum_to_one(session):
    """Over all continuations of a context, seen and unseen."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["a b", "a c", "b", "c a"]) for _ in range(rng.randrange(1, 9)))) for i in range(300)]
    known = ["a", "b", "c"]
    # held-out probes: texts of one and two words, ended
    probe = iter(i for i in range(10_000, 99_999) if zlib.crc32(str(i).encode()) % 7 == 2)
    asked = {next(probe): w for w in [["a"], ["a", "a"], ["a", "b"], ["a", "c"], ["a", "zzz"], []]}
    df = session.createDataFrame(rows + [(i, " ".join(w)) for i, w in asked.items()], "doc_id long, text string")
    p = {tuple(w): None for w in asked.values()}
    for r in lm.score_texts(df).collect():
        if r.doc_id in asked:
            p[tuple(asked[r.doc_id])] = r.score
    # The model beats add-one unigrams on text like its own.
    scored = [r for r in lm.score_texts(df).collect() if r.held_out and r.doc_id < 1000]
    assert sum(r.score for r in scored) > sum(r.base_score for r in scored)
    assert all(v is not None and v < 0 for v in p.values())
    assert p[("a", "b")] > p[("a", "zzz")] and known


def test_lm_scores_equal_brute_force(session, docs, corpus):
    """Every count, estimate and context in plain Python; only the fit of the
    mixture weights is the operator's (it has a test of its own)."""
    texts = {i: ["<0>", "<1>", *words((t or "").translate(LOWER)), "<e>"] for i, t in corpus}
    grams = lambda x, k: [tuple(x[e - k + 1 : e + 1]) for e in range(k - 1, len(x))]
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in texts}
    rows = [i for i, _ in corpus]  # ids are distinct here
    train, out = [i for i in rows if fold[i] != 2], [i for i in rows if fold[i] == 3]
    count = lambda ids: {k: Counter(g for i in ids for g in grams(texts[i], k)) for k in (1, 2, 3)}
    every, deleted = count(train), count(out)
    size = lambda ids: sum(len(texts[i]) - 2 for i in ids)
    total, distinct = size(train), len(every[1]) - 2

    def estimate(x, e, c, n):
        own = [c[k][tuple(x[e - k + 1 : e + 1])] for k in (1, 2, 3)]
        seen = [n, c[1][(x[e - 1],)], c[2][tuple(x[e - 2 : e])]]
        level = lambda v: min(int(math.log2(max(v, 1))), lm._FREQUENCIES - 1)
        context = 1 + lm._FREQUENCIES + level(seen[2]) if seen[2] > 0 else 1 + level(seen[1]) if seen[1] > 0 else 0
        return context, [a / b if b > 0 else 0.0 for a, b in zip(own, seen)]

    cells = defaultdict(lambda: [0.0] * 4)
    rest = {k: every[k] - deleted[k] for k in (1, 2, 3)}
    for i in out:
        for e in range(2, len(texts[i])):
            context, p = estimate(texts[i], e, rest, total - size(out))
            logs = [math.log2(max(v, 2.0**-60)) for v in p]
            cell = context
            for v, g in zip(p, logs):
                cell = cell * lm.LEVELS + (min(math.floor(-g), lm.LEVELS - 2) if v > 0 else lm.LEVELS - 1)
            cells[cell] = [x + y for x, y in zip(cells[cell], [1.0, *logs])]
    lam = lm.learn_weights([(c, *v) for c, v in sorted(cells.items())], 1 / (distinct + 1))
    got = {r.doc_id: r for r in lm.score_texts(docs, bucket_keys=40, chunk_bytes=3000).collect()}
    assert len(got) == len(rows)
    for i, x in texts.items():
        want = 0.0
        for e in range(2, len(x)):
            context, p = estimate(x, e, every, total)
            want += math.log10(lam[context, 0] / (distinct + 1) + sum(a * b for a, b in zip(lam[context, 1:], p)))
        assert got[i].score == pytest.approx(want, rel=1e-6)


def test_lm_weights_by_em():
    rng = np.random.default_rng(0)
    # One context; a token is explained by the bigram estimate in 70 %.
    lev, top = lm.LEVELS, 1 + lm._FREQUENCIES  # a trigram context
    cell = lambda a, b, c: ((top * lev + a) * lev + b) * lev + c
    cells = [(cell(9, 1, lev - 1), 700.0, -9.5 * 700, -1.0 * 700, 0.0), (cell(2, 12, lev - 1), 300.0, -2.0 * 300, -12.0 * 300, 0.0)]
    lam = lm.learn_weights(cells, 1e-4)
    assert np.allclose(lam.sum(1), 1) and rng is not None
    assert lam[top, 2] > 0.6 and lam[top, 1] > 0.2 and lam[top, 3] < 0.01


def _ideal(weights, blocks, t):
    """Blocks of each source that the ideal stream has run after t slots, walked
    from one end of a source to the next."""
    ran, left, t = [Fraction(0)] * len(weights), dict(enumerate(blocks)), Fraction(t)
    left = {s: Fraction(n) for s, n in left.items() if n}
    while t > 0 and left:
        rate = sum(weights[s] for s in left)
        until = min(n * rate / weights[s] for s, n in left.items())
        step = min(t, until)
        for s in list(left):
            share = step * weights[s] / rate
            ran[s] += share
            left[s] -= share
            if left[s] == 0:
                del left[s]
        t -= step
    return ran


@pytest.mark.parametrize("n", [2, 100, 600])
def test_mixing_keeps_to_the_target_weights(n):
    """One source at 0.9, the others sharing the rest: every prefix is within one
    block of the target weights, as long as all have blocks."""
    rng = random.Random(n)
    rest = [rng.random() + 0.01 for _ in range(n - 1)]
    exact = [0.9] + [0.1 * w / sum(rest) for w in rest]
    weights = [max(1, round(w * mixing.UNITS)) for w in exact]
    slots = 6000
    blocks = [-(-slots * w // sum(weights)) + 3 for w in weights]
    ran = [0] * n
    for t, (s, k) in enumerate(mixing.walk(weights, blocks)):
        if t == slots:
            break
        assert k == ran[s]
        ran[s] += 1
        # Only the source that ran and those about to be due can be off.
        if t % 7 == 0 or t < 50:
            assert all(abs(x - w * (t + 1)) < 1 + 1e-6 for x, w in zip(ran, exact))
        assert abs(ran[0] - 0.9 * (t + 1)) < 1 + 1e-6
    assert ran[0] in (5399, 5400, 5401)


def test_mixing_deviation_while_sources_run_out():
    rng = random.Random(6)
    for _ in range(25):
        n = rng.randrange(1, 9)
        weights = [rng.choice([1, 2, 3, 7, rng.randrange(1, 1000)]) for _ in range(n)]
        blocks = [rng.randrange(1, 25) for _ in range(n)]
        ran, ideal = [0] * n, mixing.Ideal(weights, blocks)
        for t, (s, k) in enumerate(mixing.walk(weights, blocks)):
            release, due = ideal.window(s, k)
            assert k == ran[s] and release <= t < due
            ran[s] += 1
            assert all(abs(x - y) < 1 for x, y in zip(ran, _ideal(weights, blocks, t + 1)))
        assert ran == blocks


def test_mix_sources_frame(session, docs, corpus, empty):
    mixed = mixing.mix_sources(docs, block_tokens=100, range_rows=7)
    assert mixed.columns[: len(docs.columns)] == docs.columns
    rows = mixed.collect()
    assert len(rows) == len(corpus)
    by_source = defaultdict(list)
    for r in rows:
        assert r.mix_tokens == len(words(r.text))
        by_source[r.source].append(r)
    slots = set()
    for source, mine in by_source.items():
        mine.sort(key=lambda r: (r.mix_offset, r.mix_tokens > 0))
        at = 0
        for r in sorted(mine, key=lambda r: (r.mix_offset, r.mix_tokens)):
            assert r.mix_offset == at
            at += r.mix_tokens
        total = sum(r.mix_tokens for r in mine)
        last = max(1, -(-total // 100)) - 1
        for r in mine:
            assert r.mix_block == min(r.mix_offset // 100, last)
        slot_of = {r.mix_block: r.mix_slot for r in mine}
        assert all(slot_of[r.mix_block] == r.mix_slot for r in mine)
        assert sorted(slot_of, key=slot_of.get) == sorted(slot_of)
        assert not slots & set(slot_of.values())
        slots |= set(slot_of.values())
    assert mixing.mix_sources(empty).count() == 0
    weighted = mixing.mix_sources(docs, {"s1": 3.0, None: 1.0}, block_tokens=100)
    assert weighted.count() == len(corpus)


def test_first_slots_of_a_mix(session, docs):
    """A filter on the slot, the main use of a mix, and columns named as the
    operator's own."""
    df = docs.withColumns({c: F.lit(c) for c in ("_mk", "_mr", "_mg", "_mh", "_row", "mix_block")})
    mixed = mixing.mix_sources(df, {"s1": 3.0, "s2": 0.5}, block_tokens=60)
    assert mixed.columns == [c for c in df.columns if c != "mix_block"] + ["mix_tokens", "mix_block", "mix_slot", "mix_offset"]
    rows = mixed.collect()
    assert {r["_mk"] for r in rows} == {"_mk"} and {r["_row"] for r in rows} == {"_row"}
    first = mixed.where("mix_slot < 7").collect()
    assert sorted(map(str, first)) == sorted(str(r) for r in rows if r.mix_slot < 7) and first
    # Bigger blocks where there would be more than wanted.
    few = mixing.mix_sources(df, block_tokens=1, max_blocks=20).agg(F.max("mix_slot")).first()[0]
    assert few < 20 + 4


def test_many_sources(session):
    n = 1200
    rows = [(i, f"site{i % n}.org" if i % n else None, " ".join(["w"] * (1 + i % 13 + (900 if i % n < 3 else 0)))) for i in range(2 * n)]
    df = session.createDataFrame(rows, "doc_id long, source string, text string")
    for weights in (None, {f"site{i}.org": 1.0 + i % 7 for i in range(1, 900)} | {None: 50.0}):
        got = mixing.mix_sources(df, weights, block_tokens=10).collect()
        assert sorted(r.doc_id for r in got) == list(range(2 * n))
        owner, last = {}, defaultdict(int)
        for r in got:
            assert owner.setdefault(r.mix_slot, (r.source, r.mix_block)) == (r.source, r.mix_block)
            last[r.source] = max(last[r.source], r.mix_block)
        assert len({r.source for r in got}) == n
        slot_of = {b: t for t, b in owner.items()}
        for s, b in slot_of:
            if (s, b - 1) in slot_of:
                assert slot_of[s, b - 1] < slot_of[s, b]
        tokens = Counter()
        for r in got:
            tokens[r.source] += r.mix_tokens
        assert max(owner) < sum(-(-t // 10) for t in tokens.values())
