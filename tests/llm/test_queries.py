"""The registered queries of the text operators, on the whole smallest test
table, against their contracts written out in plain Python or SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
from tallyfold.llm import queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, coalesce(text, '') AS text, lang FROM '{SF}/documents.parquet'").fetchall()


def run(session, name, sf=SF):
    rows = entry.queries()[name](session, sf).collect()
    return {r.doc_id: r for r in rows}, len(rows)


def test_op1_base_columns(session, docs):
    got, n = run(session, "op1_lm_scoring")
    assert n == len(docs)
    tokens = {i: [*WORD.findall(t.translate(LOWER)), None] for i, t, _ in docs}
    train = Counter(w for i in tokens if zlib.crc32(str(i).encode()) % 7 != 2 for w in tokens[i])
    total, kinds = sum(train.values()), len(train)
    for i, own in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 7 == 2, len(own), sum(w in train for w in own), total)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 1) / (total + kinds + 1)) for w in own), rel=1e-9)
        assert r.score < 0


def test_op2_places_every_document(session, docs):
    got, n = run(session, "op2_mix_sources")
    assert n == len(docs) and all(got[i].mix_tokens == len(WORD.findall(t)) for i, t, _ in docs)
    owner = {}
    for r in got.values():
        assert owner.setdefault(r.mix_slot, (r.source, r.mix_block)) == (r.source, r.mix_block)


def test_op4_equals_its_sql(session):
    for t in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = duckdb.sql(queries.SQL["op4_decontamination"])
    got = entry.queries()["op4_decontamination"](session, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_op5_base_spans(session):
    sf = "/root/testdata/sf0.01"  # the smallest table has no secrets
    docs = duckdb.sql(f"SELECT doc_id, coalesce(text, ''), 0 FROM '{sf}/documents.parquet'").fetchall()
    got, n = run(session, "op5_secret_scan", sf)
    assert n == len(docs)
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    some = 0
    for i, t, _ in docs:
        spans = [("assign", m.start(), m.end()) for m in assign.finditer(t) if len(m[2]) >= 8]
        spans += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        spans += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 32]
        spans.sort(key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))
        count = Counter(k for k, _, _ in spans)
        r, text = got[i], [f"{k}:{a}:{b}" for k, a, b in spans]
        assert (r.n_assign, r.n_access, r.n_hex) == (count["assign"], count["access"], count["hex"])
        assert r.base_sha256 == sha(",".join(text)) and set(text) <= set(r.spans.split(","))
        some += bool(spans)
    assert some > 3


def test_op6_components(session, docs):
    got, n = run(session, "op6_ngram_jaccard")
    assert n == len(docs)
    sets = {}
    for i, t, _ in docs:
        w = WORD.findall(t.translate(LOWER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    assert {i: (got[i].n_shingles, got[i].component_id) for i in ids} == {i: (len(sets[i]), find(i)) for i in ids}
    assert len({find(i) for i in ids}) < len(ids)


def test_op7_languages(session, docs):
    got, n = run(session, "op7_language_id")
    known = {lang for _, _, lang in docs if lang}
    assert n == len(docs)
    for i, t, _ in docs:
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.lang_pred == "und" if not any(c.isalpha() for c in t) else r.lang_pred in known
    held = [(got[i].lang_pred, lang) for i, t, lang in docs if got[i].held_out and lang and len(t) > 80]
    assert sum(a == b for a, b in held) >= 0.95 * len(held) and len(held) > 20


def test_op8_base_columns(session, docs):
    got, n = run(session, "op8_quality_rules")
    assert n == len(docs)
    for i, t, _ in docs:
        w, seen, dup = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        places = defaultdict(list)
        for k in range(len(w) - 7):
            places[tuple(w[k : k + 8])].append(k)
        repeated = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(8)}
        r = got[i]
        want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeated))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 20 or 100 * len(repeated) > 30 * len(w))
        assert not (r.base_failed and r.kept)


def test_op9_finds_notices(session, docs):
    _, n = run(session, "op9_license_scan")
    assert n >= len(docs)


def test_op10_kept_words(session, docs):
    got, n = run(session, "op10_substring_dedup")
    assert n == len(docs)
    words = {i: WORD.findall(t) for i, t, _ in docs}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][k : k + 50]), i)
    removed = 0
    for i, w in words.items():
        gone = {k + j for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for j in range(50)}
        removed += len(gone)
        r = got[i]
        assert (r.n_words, r.n_removed) == (len(w), len(gone))
        assert r.kept_sha256 == sha(" ".join(x for k, x in enumerate(w) if k not in gone))
    assert removed > 0
