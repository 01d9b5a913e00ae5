"""Line dedup, cross-tokenizer alignment and periodic runs against brute
force, and their registered queries against the contract written out."""

import hashlib
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from tallyfold.llm import crosstok, line_runs, periodic, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def sf_documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


# ------------------------------------------------------------- line dedup


def brute_lines(rows, min_chars=40, min_docs=5):
    """Rows (id, text) -> sorted (id, n_lines, n_dropped, text)."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        if i is not None:
            for line in (t or "").split("\n"):
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        gone = [i is not None and len(key(x)) >= min_chars and len(holders[key(x)]) >= min_docs and max(holders[key(x)]) != i for x in lines]
        out.append((i, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out, key=str)


def line_corpus(seed, n=60):
    rng = random.Random(seed)
    pool = [f"a line that many documents hold, number {k} of them all" for k in range(8)]
    pool += ["Ünïcode line, forty code points or a few more " + "é" * 3, "x" * 39, "y" * 40, "É" * 40, "é" * 40, "short"]
    dress = [lambda x: x, str.upper, lambda x: f"  {x}\t", lambda x: f"\x0b{x}\r", lambda x: f"{x}\xa0"]
    rows = [(i, "\n".join(rng.choice(dress)(rng.choice(pool)) for _ in range(rng.randrange(0, 9)))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "\n\n"), (n + 3, "\n".join([pool[0], "end"] * 2000)), (-5, pool[1]), (3, pool[2]), (4, rows[4][1])]


@pytest.mark.parametrize("seed,batches,fanout", [(1, 4, 2), (2, 1, 2), (3, 7, 3)])
def test_line_dedup_equals_brute_force(session, seed, batches, fanout):
    rows = line_corpus(seed)
    df = session.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, _id string, _pos int").repartition(4)
    got = line_runs.dedupe_lines(df, batches=batches, fanout=fanout)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_lines(rows)


def test_line_runs_are_levelled_and_reopened(session):
    rows, name = line_corpus(9, 80), f"tallyfold_lines_{uuid.uuid4().hex[:8]}"
    df = session.createDataFrame(rows, "doc_id long, text string")
    store = line_runs.LineRuns(session, name, n_buckets=4)
    # Ids in no order; a document's rows stay in one batch.
    for k in (2, 0, 3):
        store.add(df.where(f"pmod(doc_id, 4) = {k}"))
    assert [level for level, _ in store.runs] == [1, 0]
    again = line_runs.LineRuns(session, name, n_buckets=4)
    assert sorted(again.runs) == sorted(store.runs)
    again.add(df.where("pmod(doc_id, 4) = 1"))
    assert [level for level, _ in again.runs] == [2]
    assert sorted(map(tuple, again.drop_lines(df).collect()), key=str) == brute_lines(rows)
    keys = again.run(again.runs[0])
    assert keys.count() == keys.select("_h1", "_h2").distinct().count()
    assert [t.name for t in session.catalog.listTables(pattern=f"{name}*")] == [f"{name}_l2_r{again.runs[0][1]}"]
    session.sql(f"DROP TABLE {name}_l2_r{again.runs[0][1]}")


def test_settled_keys_are_not_stored_again(session):
    line = "this line is held by every document of the corpus"
    df = session.createDataFrame([(i, line) for i in range(40)], "doc_id long, text string")
    store = line_runs.LineRuns(session, n_buckets=2, fanout=9)
    store.add(df.where("doc_id >= 30"))
    store.add(df.where("doc_id < 30"))
    assert [store.run(r).count() for r in store.runs] == [1, 0]
    store.add(df.where("doc_id = 5").selectExpr("doc_id + 100 AS doc_id", "text"))  # a larger id is
    assert [store.run(r).count() for r in store.runs] == [1, 0, 1]
    assert {r.doc_id: r.n_dropped for r in store.drop_lines(df.union(session.createDataFrame([(105, line)], df.schema))).collect()} == {
        **dict.fromkeys(range(40), 1),
        105: 0,
    }


def test_line_dedup_edges(session, empty):
    assert line_runs.dedupe_lines(empty).collect() == []
    line = "a line of a row without an id, forty code points"
    df = session.createDataFrame([(None, line)] * 6 + [(1, None)], "doc_id long, text string")
    assert sorted(map(tuple, line_runs.dedupe_lines(df).collect()), key=str) == sorted([(None, 1, 0, line)] * 6 + [(1, 1, 0, "")], key=str)


# ---------------------------------------------------- tokenizer alignment


@pytest.fixture(scope="module")
def vocabularies():
    return crosstok.read_vocabularies(queries.BYTES, queries.VOCABULARY)


def brute_alignment(texts, a, b):
    """Whole texts, token by token; no words, no runs."""
    words = crosstok.Words(a, b)
    out, linked = [], []
    for t in texts:
        out.append((0, 0, 0, 0, ""))
        linked.append(Counter())
        if not t:
            continue
        ids_a, ids_b = words.a.encode(" " + t, add_special_tokens=False).ids, words.b.encode(t)
        parts_a, parts_b = [words.bytes_a[x] for x in ids_a], [words.bytes_b[x] for x in ids_b]
        if b"".join(parts_a) != (" " + t).encode() or b"".join(parts_b) != (" " + t).encode():
            continue
        end_a, end_b = np.cumsum([len(x) for x in parts_a]), np.cumsum([len(x) for x in parts_b])
        start_a, start_b = end_a - [len(x) for x in parts_a], end_b - [len(x) for x in parts_b]
        links = [(i, j) for i in range(len(ids_a)) for j in range(len(ids_b)) if start_a[i] < end_b[j] and start_b[j] < end_a[i]]
        groups, low = [], 0
        for cut in sorted(set(end_a) & set(end_b)):
            own = [",".join(str(x) for x, s in zip(ids, starts) if low <= s < cut) for ids, starts in ((ids_a, start_a), (ids_b, start_b))]
            groups.append("|".join(own))
            low = cut
        out[-1] = (len(ids_a), len(ids_b), len(groups), len(links), sha(";".join(groups)))
        linked[-1] = Counter((ids_a[i], ids_b[j]) for i, j in links)
    counts, most = Counter(p for c in linked for p in c), defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = []
    for o, c in zip(out, linked):
        rows.append((*o[:4], sum(m for p, m in c.items() if counts[p] == most[p[0]]), sum(m * counts[p] for p, m in c.items()), o[4]))
    return rows, counts, most


def token_corpus(seed, n=150):
    rng = random.Random(seed)
    parts = ["a", "b", "the", "ing", "é", "ß", "日本", "🙂", "  ", " ", " ", " ", "\n", "\t", "'s", "123", "<|endoftext|>", "<0x41>", "\xa0", "　"]
    parts += [" ", "\x1c", "!?", "...", "​", "\x00", "x" * 50, "́", "᠎", "\x85", "﷽", "<s>", "\r\n"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    return [None, "", " ", "  ", "▁", "a▁b c", "\n", " a ", "a  b", *made, *made[:20], "z" * 5000, "w " * 3000]


def test_alignment_equals_brute_force(session, vocabularies, monkeypatch):
    texts = token_corpus(4)
    expected, counts, most = brute_alignment(texts, *vocabularies)
    df = session.createDataFrame([(i, t, "clash", 0) for i, t in enumerate(texts)], "doc_id long, text string, _r string, _spill int").repartition(6)
    fields = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for ways in (2, 256):  # several merge levels and shares, or one
        got = crosstok.align_documents(df, *vocabularies, ways=ways).collect()
        assert [tuple(r[f] for f in fields) for r in sorted(got)] == expected
    pairs = crosstok.pair_counts(df, *vocabularies, ways=3).collect()
    assert {(r.a_id, r.b_id): (r.n_docs, r.is_best) for r in pairs} == {p: (n, n == most[p[0]]) for p, n in counts.items()}
    assert len(pairs) == len(counts)
    groups = crosstok.token_groups(df, *vocabularies).collect()
    assert [sha(r.groups) if r.groups else "" for r in sorted(groups)] == [e[-1] for e in expected]


def test_alignment_with_small_spills(vocabularies, monkeypatch):
    """Many spills a task, and words forgotten between them."""
    monkeypatch.setattr(crosstok, "KEEP_WORDS", 40)
    words, texts = crosstok.Words(*vocabularies), token_corpus(6, 60)
    import pyarrow as pa

    expected, counts, _ = brute_alignment(texts, *vocabularies)
    monkeypatch.setattr(crosstok, "slices", lambda c: ((k, min(k + 7, len(c))) for k in range(0, len(c), 7)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    heads, rows = [], []
    for ids, numbers, _size in crosstok._encoded(words, [batch]):
        for r, head, body in crosstok._spill(words, [ids], numbers):
            if r >= 0:
                pairs, docs_of = crosstok._unhead(head)
                assert (crosstok.radix_of(pairs >> 32) == r).all() and (np.diff(pairs) > 0).all()
                _, _, doc, links = crosstok._unrecord(head, body)
                assert len(doc) == docs_of.sum() == len(links) and doc.max(initial=0) < len(numbers)
                heads.append(head)
            else:
                rows += pa.ipc.open_stream(body).read_all().to_pylist()
    pairs, total = crosstok.merged(heads)
    assert {(p >> 32, p & 0xFFFFFFFF): n for p, n in zip(pairs.tolist(), total.tolist())} == dict(counts)
    assert [(r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) for r in rows] == [(*e[:4], e[6]) for e in expected]


def test_alignment_edges(session, empty, vocabularies):
    assert crosstok.align_documents(empty, *vocabularies).collect() == []
    assert crosstok.pair_counts(empty, *vocabularies).collect() == []
    df = session.createDataFrame([(None, "one two"), (None, "one two"), (7, None)], "doc_id long, text string")
    got = sorted(map(tuple, crosstok.align_documents(df, *vocabularies).collect()), key=str)
    assert got[0] == (7, 0, 0, 0, 0, "", 0, 0) or got[-1] == (7, 0, 0, 0, 0, "", 0, 0)
    assert sum(r[0] is None and r[1] == 2 and r[-1] == 4 for r in got) == 2  # two links, each in two rows


# ------------------------------------------------------------ periodic runs


def brute_runs(x, least=24, repeats=3):
    out = []
    for q in range(1, len(x) // repeats + 1):
        k = 0
        while k < len(x) - q:
            if x[k] != x[k + q]:
                k += 1
                continue
            j = k
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            own = x[k : j + q]
            if len(own) >= max(least, repeats * q) and all(any(own[t] != own[t + p] for t in range(len(own) - p)) for p in range(1, q)):
                out.append((k, len(own), q))
            k = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(x, runs):
    return [w for i, w in enumerate(x) if not any(s + q <= i < s + n for s, n, q in runs)]


def looping_texts(seed, n=40):
    rng, out = random.Random(seed), []
    for _ in range(n):
        size, vocabulary = rng.randrange(0, 260), rng.choice([1, 2, 3, 5, 50, 100_000])
        x = [rng.randrange(vocabulary) for _ in range(size)]
        for _ in range(rng.randrange(0, 4) if size > 30 else 0):
            p, s = rng.randrange(1, 40), rng.randrange(0, size - 1)
            for t in range(s + p, min(size, s + int(p * rng.uniform(2, 8)))):
                x[t] = x[t - p]
        if rng.random() < 0.2:
            x = ([0] * rng.randrange(20, 60) + [rng.randrange(3) for _ in range(rng.randrange(1, 10))]) * 4
        out.append(x)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_VALUES", (1 << 20, 200)[seed % 2])
    texts = looping_texts(seed)
    ids = np.array([w for x in texts for w in x], np.int64)
    _, ids = np.unique(ids, return_inverse=True)
    hashes = np.random.default_rng(seed).integers(0, 1 << 63, len(ids) + 1).astype(np.uint64)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    assert periodic.find_runs(ids, hashes, offsets) == [brute_runs(x) for x in texts]


def test_transforms_find_exact_zeros():
    rng = np.random.default_rng(2)
    for length, width, top in ((8, 22, 5), (16, 31, 100_000), (3, 9, 1 << 30), (64, 127, 2)):
        blocks, spans = rng.integers(0, top, (6, length)), rng.integers(0, top, (6, width))
        spans[2, 3 : 3 + length] = blocks[2]
        want = [[(s[d : d + length] == b).all() for d in range(width - length + 1)] for b, s in zip(blocks, spans)]
        assert (periodic.zero_distances(blocks, spans, top) == want).all()


def test_runs_of_a_long_text(session):
    """Long periods, with smaller runs inside each period."""
    rng = random.Random(3)
    period = [f"w{rng.randrange(500)}" for _ in range(3000)]
    period[100:160] = ["a", "b"] * 30
    words = ["start"] + period * 4 + period[:777] + ["end"]
    rows = [(1, " ".join(words)), (2, None), (3, ""), (4, "a " * 23), (5, "a " * 24), (None, "\x0ba\tb " * 12), (1, "x")]
    got = periodic.periodic_runs(session.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, runs int").repartition(2))
    assert got.columns == ["doc_id", "n_words", "runs", "text"]
    got = {(r.doc_id, r.n_words): ([tuple(x) for x in r.runs], r.text) for r in got.collect()}
    long_runs, left = got[1, len(words)]
    assert (1, 3000 * 4 + 777, 3000) in long_runs
    assert long_runs == sorted([(1, 12777, 3000)] + [(1 + 100 + 3000 * k, 60, 2) for k in range(5)], key=lambda r: (r[0], r[2]))
    assert left == " ".join(collapse(words, long_runs))
    assert got[2, 0] == got[3, 0] == ([], "")
    assert got[4, 23] == ([], "a" + " a" * 22) and got[5, 24] == ([(0, 24, 1)], "a")
    assert got[None, 24] == ([(0, 24, 2)], "a b") and got[1, 1] == ([], "x")


def test_runs_of_an_empty_table(empty):
    assert periodic.periodic_runs(empty).collect() == []


# ------------------------------------------------------ registered queries


def test_line_query_equals_its_sql(session):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = duckdb.sql(queries.SQL["op11_line_dedup"])
    got = entry.queries()["op11_line_dedup"](session, SF).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    assert sorted((i, n, d, k) for i, n, d, k in map(tuple, got.collect())) == sorted((i, n, d, sha(t)) for i, n, d, t in brute_lines(sf_documents()))


def test_alignment_query_equals_brute_force(session, vocabularies):
    rows = [(i, t) for i, t in sf_documents() if t is None or len(t) < 4000]
    whole = {r.doc_id: r for r in entry.queries()["op12_token_alignment"](session, SF).collect()}
    assert len(whole) == len(sf_documents())
    # Counts of the corpus need every text, so texts of all lengths take part.
    expected, _, _ = brute_alignment([t for _, t in rows], *vocabularies)
    for (i, _), e in zip(rows, expected):
        assert (whole[i].n_a, whole[i].n_b, whole[i].n_groups, whole[i].n_links, whole[i].groups_sha256) == (*e[:4], e[6])


def test_periodic_query_equals_brute_force(session):
    got = {r.doc_id: r for r in entry.queries()["op13_periodic_runs"](session, SF).collect()}
    rows = sf_documents()
    assert len(got) == len(rows)
    looped = 0
    for i, t in rows:
        x, h = WORD.findall(t or ""), zlib.crc32(str(i).encode())
        n, g = len(x), h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            x = [x[k] if k < a else x[a + (k - a) % p] for k in range(n)]
            looped += 1
        if n > 1500:
            continue
        runs, r = brute_runs(x), got[i]
        best = max(runs, key=lambda v: (v[1] / v[2], -v[0], -v[2]), default=None)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r.collapsed_sha256 == sha(" ".join(collapse(x, runs)))
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
    assert looped > 5
