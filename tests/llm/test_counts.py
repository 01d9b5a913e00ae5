"""Secret spans, token counts, licenses, language and quality statistics
against plain Python."""

import base64
import gzip
import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyfold.llm import langid, licenses, rules, secret_scan, text, wordpiece

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(t):
    return WORD.findall(t or "")


def test_word_split_is_the_pattern():
    odd = [" a b\x0bc  ", "", "\x1cx y\x85z\xa0w v", "\r\n\tq\x1f", "é\x0c\x0cß"]
    offsets, flat = text.split_words(text.texts(pa.array([*odd, None])))
    got = [flat.slice(a, b - a).to_pylist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [words(t) for t in odd] + [[]]


def test_window_fingerprints_tell_runs_apart():
    h = np.array([5, 7, 5, 7, 5, 7, 9, 5, 7, 5], np.uint64)
    for k in range(1, 8):
        fps = text.windows(h, k)
        runs = [tuple(h[i : i + k]) for i in range(len(h) - k + 1)]
        assert len(fps) == len(runs)
        assert all((fps[i] == fps[j]) == (runs[i] == runs[j]) for i in range(len(runs)) for j in range(len(runs)))


def test_base_spans_and_drops():
    t = 'secret: token:abcdefghi PassWD="12345678" AKIA1234 AKIAABCDEFGHIJKL ' + "0af9" * 8 + " api key=zzzzzzzzz apikey=zzzzzzzzz"
    base, spans = secret_scan.find_secrets(t)
    want = []
    for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t):
        if len(m[1]) >= 8:
            want.append(("assign", m.start(), m.end()))
    want += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    want += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    assert base == sorted(want, key=lambda x: (x[1], secret_scan.KINDS.index(x[0])))
    assert set(base) <= set(spans)
    assert secret_scan.find_secrets("pa\u017f\u017fword=12345678 to\u212aen=123456789")[0] == []


@pytest.mark.parametrize("depth", range(1, 5))
def test_nested_layers_are_unwrapped(depth):
    secret = "password=hunter2hunter2"
    wraps = [
        lambda s: base64.b64encode(s.encode()).decode(),
        lambda s: "".join(f"%{b:02X}" for b in s.encode()),
        lambda s: base64.b64encode(gzip.compress(s.encode())).decode(),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: s.encode().hex(),
        lambda s: base64.urlsafe_b64encode(s.encode()).decode().rstrip("="),
    ]
    for i in range(len(wraps)):
        inner = secret
        for d in range(depth):
            inner = wraps[(i + d) % len(wraps)](inner)
        t = f"é before {inner} after"
        base, spans = secret_scan.find_secrets(t)
        found = [s for s in spans if s[0] == "assign"]
        assert found, (i, depth)
        for _, a, b in found:
            assert 9 <= a < b <= 9 + len(inner)
        clean = secret_scan.redact(t, spans)
        assert clean.startswith("é before ") and clean.endswith(" after")


def test_escapes_map_back_exactly():
    t = "x pass%77ord=abcdefgh%31 y"
    _, spans = secret_scan.find_secrets(t)
    assert spans == [("assign", 2, len(t) - 2)]


def _assigned(t):
    return [(a, b) for kind, a, b in secret_scan.find_secrets(t)[1] if kind == "assign"]


def test_bad_bytes_and_unprintable_characters_hide_nothing():
    t = "https://x.org/caf%E9?password%3Dhunter2secret"
    assert (t.index("password"), len(t)) in _assigned(t)
    secret, fill = "password=hunter2hunter2", " ".join(hashlib.sha256(b"%d" % i).hexdigest()[:9] for i in range(3000))
    for odd in ("\xa0", "\u3000", "\u200b", "\ufeff", "\0"):
        raw = f"{odd}{fill} {secret} {fill}{odd}".encode()
        for blob in (raw, b"\xff" + raw, gzip.compress(raw)):
            assert _assigned("x " + base64.b64encode(blob).decode()), odd
    raw = f"{secret} {fill}".encode()
    packed = gzip.compress(raw)
    broken = bytearray(packed)
    broken[-6] ^= 1  # the checksum
    hurt = bytearray(packed)
    hurt[len(hurt) // 2 :] = b"\xff" * (len(hurt) - len(hurt) // 2)
    plain = gzip.compress(fill.encode())
    for blob in (packed[: len(packed) // 2], bytes(broken), bytes(hurt), plain + packed, plain + plain + packed[:-20], plain + secret.encode(),
                 gzip.compress(b"password=hun") + gzip.compress(b"ter2hunter2")):
        assert _assigned("x " + base64.b64encode(blob).decode())
        assert _assigned("x " + blob.hex())


def test_secrets_across_spaces_beside_escapes():
    for t in (
        r"{\u0022password\u0022: \u0022hunter2hunter2\u0022}",
        "pass%77ord = hunter2hunter2",
        r"é pass\x77ord : %68unter2hunter2",
        "é%20token%3A hunter2hunter%32 é",
        "caf%C3%A9 é api%5Fkey = hunter2%68unter2",
    ):
        a = next(t.index(w) for w in ("pass", "token", "api") if w in t)
        b = max(t.rindex(w) + len(w) for w in ("hunter2", "unter2", "%32", "hunter2hunter2") if w in t)
        assert _assigned(t) == [(a, b)], t
        assert "unter2" not in secret_scan.redact(t, secret_scan.find_secrets(t)[1])


def test_wrapped_and_glued_runs_are_read():
    secret = b"password=hunter2hunter2"
    rng = random.Random(6)
    fill = " ".join(f"{rng.randrange(10**9):x}" for _ in range(300)).encode()
    import zlib

    for raw in (secret, b"x" * 43 + secret + b"x" * 40 + b" end", gzip.compress(fill + b" " + secret + b" " + fill), zlib.compress(fill + secret, 9)):
        for eol in ("\n", "\r\n", "\n  "):
            for width in (64, 76):
                flat = base64.b64encode(raw).decode()
                t = "see\n" + eol.join(flat[i : i + width] for i in range(0, len(flat), width)) + "\nbye now"
                assert _assigned(t), (raw[:9], eol, width)
                h = raw.hex()
                assert _assigned("see\n" + eol.join(h[i : i + 60] for i in range(0, len(h), 60)))
        for glue in ("id-", "a_", "abcd/", "x-y-z-", "ab/c/", "path/to-"):
            for encode in (base64.b64encode, base64.urlsafe_b64encode):
                assert _assigned("see " + glue + encode(raw).decode()), (glue, raw[:9])
    t = "id-cGFzc3dvcmQ9aHVudGVyMmh1bnRlcjI="
    assert _assigned(t) == [(3, len(t) - 1)]
    wrapped = "internationalization\n" + "\n".join([base64.b64encode(gzip.compress(fill + secret)).decode()[i : i + 76] for i in range(0, 4000, 76)])
    assert _assigned(wrapped.rstrip("\n"))
    assert _assigned(b"token=12345678".hex()) == [(0, 28)] and _assigned("a" + b"token=12345678".hex()) == [(1, 29)]


def test_cycle_ends():
    t = "%2525252541" * 50 + " " + "A" * 4000
    secret_scan.find_secrets(t)


def test_secrets_in_every_kind_of_escape():
    secret = "password=hunter2hunter2"
    spell = lambda f: "".join(f(c) for c in secret)
    wide = [secret.encode("utf-16-le"), secret.encode("utf-16-be"), ("é " + secret).encode("utf-16-le"), b"x" + secret.encode("utf-16")]
    for t in (
        "%u0070assword=hunter2hunter2",
        r"\u{70}assword=hunter2hunter2",
        r"\U00000070assword=hunter2hunter2",
        "&#112;assword&#x3d;hunter2hunter2",
        spell(lambda c: f"\\u{ord(c):04x}"),
        spell(lambda c: f"\\u{{{ord(c):x}}}"),
        spell(lambda c: f"\\U{ord(c):08x}"),
        spell(lambda c: f"%u{ord(c):04X}"),
        spell(lambda c: f"&#{ord(c)};"),
        "user=a+b&password+%3D+hunter2hunter2",
        "password+=+hunter2hunter2",
        *[base64.b64encode(w).decode() for w in wide],
        *[w.hex() for w in wide],
    ):
        text = f"see {t} end"
        base, spans = secret_scan.find_secrets(text)
        got = [(a, b) for kind, a, b in spans if kind == "assign"]
        assert got, t
        assert all(4 <= a < b <= 4 + len(t) for a, b in got), t
        assert "hunter2hunter2" not in secret_scan.redact(text, spans)
    # No character has these numbers: they stay and hide nothing.
    odd = r"\U00110000 \u{FFFFFF} &#9999999; password=hunter2hunter2"
    assert [k for k, _, _ in secret_scan.find_secrets(odd)[1]] == ["assign"]


def test_secrets_in_data_that_expands_a_thousandfold(monkeypatch):
    """Nothing is cut off, and one block of a layer is held at a time."""
    monkeypatch.setattr(secret_scan, "BLOCK", 1 << 20)
    monkeypatch.setattr(secret_scan, "OVERLAP", 1 << 16)
    fill = b"\0" * (24 << 20)
    for raw in (zlib.compress(fill + b" password=hunter2hunter2", 9), gzip.compress(fill + b"token:abcdefgh1 ", 9)):
        assert len(raw) * 900 < len(fill)
        t = "a " + base64.b64encode(raw).decode() + " z"
        tracemalloc.start()
        _, spans = secret_scan.find_secrets(t)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert any(k == "assign" and 2 <= a < b <= len(t) - 2 for k, a, b in spans)
        assert peak < 10 * secret_scan.BLOCK < len(fill)


def test_blocks_of_unpacked_data_hide_nothing_at_their_borders(monkeypatch):
    monkeypatch.setattr(secret_scan, "BLOCK", 4000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 300)
    noise = random.Random(3)
    secret = b"password=hunter2hunter2"
    inner = base64.b64encode(b"x" * 20 + secret + b"y" * 40)
    for at in [*range(3650, 4050, 7), 7399, 7701]:
        fill = bytes(noise.choice(b"abc def ghi jkl\n") for _ in range(9000))
        for hidden in (b" " + secret + b" ", b" " + inner + b" "):
            raw = gzip.compress(fill[:at] + hidden + fill[at:])
            t = f"q {raw.hex()} q"
            assert [k for k, _, _ in secret_scan.find_secrets(t)[1] if k == "assign"], at


def test_scan_secrets_frame(session, docs, empty):
    got = {r.doc_id: r for r in secret_scan.scan_secrets(docs).collect()}
    assert len(got) == docs.select("doc_id").distinct().count()
    assert secret_scan.scan_secrets(empty).count() == 0


def _greedy(word, start, rest):
    n, at = 0, 0
    while at < len(word):
        pool = start if at == 0 else rest
        for end in range(len(word), at, -1):
            if word[at:end] in pool:
                break
        else:
            return 0
        n, at = n + 1, end
    return n


def test_longest_match_counts_equal_greedy():
    rng = random.Random(3)
    for _ in range(60):
        piece = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 6)))
        start, rest = {piece() for _ in range(rng.randrange(1, 12))}, {piece() for _ in range(rng.randrange(1, 12))}
        machine = wordpiece.LongestMatch(sorted(start), sorted(rest))
        for _ in range(200):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))
            assert machine.count(word) == _greedy(word, start, rest), (word, start, rest)


def test_words_behind_the_bare_mark_equal_greedy():
    import sentencepiece

    from tallyfold.llm.queries import VOCABULARY

    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    kept = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    pieces = {model.id_to_piece(i) for i in kept}
    start, rest = {p for p in pieces if p[0] == "▁"}, {p for p in pieces if "▁" not in p}

    def greedy(word):
        marked, n, at = "▁" + word, 0, 0
        while at < len(marked):
            pool = rest if at else start
            end = next((e for e in range(min(len(marked), at + 48), at, -1) if marked[at:e] in pool), None)
            if end is None:
                return 0
            n, at = n + 1, end
        return n

    machine = wordpiece.LongestMatch(*wordpiece.sentencepiece_vocabulary(VOCABULARY))
    said = ["ñandú", "¡hola!", "çà", "êtes", "ß", "中文字", "中" * 10_000, "日本語のテスト", "한국어", "😀", "hello", "x中", "\u0378", "ñ\u0378"]
    assert [machine.count(w) for w in said] == [greedy(w) for w in said]
    assert machine.count("中" * 10_000) == 10_001 and machine.count("ñandú") > 1
    rng = random.Random(4)
    letters = sorted({c for p in rest for c in p})
    for _ in range(3000):
        word = "".join(rng.choice(letters) for _ in range(rng.randrange(1, 7)))
        assert machine.count(word) == greedy(word), word
    for _ in range(300):
        piece = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(1, 5)))
        first, then = {piece() for _ in range(rng.randrange(1, 8))}, {piece() for _ in range(rng.randrange(1, 8))}
        machine = wordpiece.LongestMatch(sorted(first | {""}), sorted(then))
        start, rest = {"▁" + p for p in first | {""}}, then
        for _ in range(20):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))
            assert machine.count(word) == greedy(word), (word, first, then)


def test_count_pieces_frame(session, docs, corpus, empty):
    start, rest = {"w", "w1", "one", "e", "a", "b"}, {"1", "2", "23", "4", "0", "é", "5", "6", "7", "8", "9", "3", "dit"}
    machine = wordpiece.LongestMatch(sorted(start), sorted(rest))
    got = Counter(tuple(r) for r in wordpiece.count_pieces(docs, machine).collect())
    want = Counter()
    for i, t in corpus:
        each = [_greedy(w, start, rest) for w in words(t)]
        want[(i, len(each), sum(max(1, n) for n in each), sum(n == 0 for n in each))] += 1
    assert got == want
    assert wordpiece.count_pieces(empty, machine).count() == 0


def test_patience_alignment_pairs_equal_words():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 20))]
        b = [rng.choice("abcdefgh") for _ in range(rng.randrange(0, 12))]
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))
    assert licenses.align("x a b c y".split(), "a b c".split()) == [(1, 0), (2, 1), (3, 2)]


def test_licenses_found_anywhere(session, empty):
    mit = licenses.TEMPLATES["MIT"]
    filler = " ".join(f"word{i}" for i in range(900))
    changed = mit.replace("free of charge", "at no cost").upper()
    rows = [(1, f"{filler} {mit} {filler}"), (2, f"{mit}\n{filler}\n{mit}"), (3, changed), (4, filler), (5, None), (6, "Released under the MIT License.")]
    df = session.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan_licenses(df).collect()}
    assert got[1].license == got[2].license == "MIT" and got[1].coverage == 1.0 == got[2].coverage
    assert got[3].license == "MIT" and 0.95 < got[3].coverage < 1
    assert got[4].license is None and got[5].license is None
    assert got[6].license == "MIT notice"
    assert licenses.scan_licenses(empty).count() == 0


def test_licenses_are_found_whatever_stands_before():
    rng = random.Random(9)
    for name, keep, extra in (("MIT", 0.85, 0.3), ("GPL-3.0 header", 1.0, 0.9), ("Apache-2.0 header", 0.9, 0.6)):
        template = licenses.words_of(licenses.TEMPLATES[name])
        m = len(template)
        kept = sorted(rng.sample(range(m), -int(-keep * m // 1)))
        spread = [template[i] for i in kept]
        for i in range(int(extra * m)):
            spread.insert(rng.randrange(1, len(spread)), f"extra{i}")
        want = licenses.best_match(spread, template, 0.8)
        assert want
        for before in range(0, 2 * m, 7):
            text = [f"word{i}" for i in range(before)] + spread + [f"more{i}" for i in range(3 * m)]
            assert licenses.best_match(text, template, 0.8) == (want[0], before + want[1], before + want[2]), (name, before)


def _stats(t):
    t = t or ""
    w = words(t)
    lines = [x for x in t.split("\n") if words(x)]
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {p for i in range(len(w) - 7) if grams[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def test_statistics_equal_plain_python(session, docs, corpus, empty):
    got = Counter(
        (r.doc_id, *(r._tf_stats[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), r._tf_failed, r._tf_kept)
        for r in rules.judge(docs, []).collect()
    )
    want = Counter()
    for i, t in corpus:
        s = _stats(t)
        failed = s[0] < 20 or 100 * s[4] > 30 * s[0]
        want[(i, *s, failed, not failed)] += 1
    assert got == want
    assert rules.judge(empty, []).count() == 0


def test_rules_are_learned_and_emitted(session):
    rng = np.random.default_rng(0)
    x = rng.random((2000, len(rules.FEATURES)))
    bad = (x[:, 2] > 0.8) & (x[:, 4] <= 0.5) | (x[:, 0] < 0.1)
    learned = rules.learn_rules(x, bad)
    assert learned
    predicted = np.zeros(len(x), bool)
    for r in learned:
        predicted |= rules._holds(r, x)
    assert (predicted == bad).mean() > 0.97
    assert rules.learn_rules(x, np.zeros(len(x), bool)) == []


def test_fit_rules_from_labels(session, empty):
    rows = [(i, " ".join(["##%d" % j if i % 2 else "word%d" % j for j in range(30 + i % 7)])) for i in range(400)]
    df = session.createDataFrame(rows, "doc_id long, text string")
    labels = session.createDataFrame([(i, int(i % 2 == 0)) for i in range(300)] + [(5, None), (6, 0)], "doc_id long, quality int")
    learned = rules.fit_rules(df, labels)
    kept = {r.doc_id: r._tf_kept for r in rules.judge(df, learned).collect()}
    assert all(kept[i] == (i % 2 == 0) for i, _ in rows)
    assert rules.fit_rules(empty, labels.limit(0)) == []


def test_language_model_holds_out(session, empty):
    rng = random.Random(2)
    syllables = {"aa": ["ba", "na", "ta"], "bb": ["ke", "me", "xe"], "cc": ["õl", "ül", "zu"]}
    rows = []
    for i in range(300):
        lang = sorted(syllables)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(syllables[lang], k=3)) for _ in range(25)), lang))
    rows += [(900, None, "aa"), (901, "123 !?", "bb"), (902, "nabata", None)]
    df = session.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(df.where("doc_id % 2 = 0"))
    got = {r.doc_id: r for r in langid.identify(df, model).collect()}
    assert all(got[i].lang_pred == lang for i, _, lang in rows[:300])
    assert got[900].lang_pred == got[901].lang_pred == "und" and got[900].score == 0.0
    assert got[902].lang_pred == "aa"
    assert all(0 <= r.score <= 1 for r in got.values())
    none = langid.fit_languages(empty)
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(500, 3)) * 8
    y = np.where(rng.random(500) < 0.7, logits.argmax(1), rng.integers(0, 3, 500))
    assert langid.calibrate(logits, y) > 1.5


def test_digest_of_no_span():
    assert hashlib.sha256(secret_scan.join_spans([]).encode()).hexdigest().startswith("e3b0c442")


def _order_of(a, b, pairs):
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))


def _longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment_cannot_be_extended():
    """No equal words are left between two neighbouring pairs; with words that
    occur once it is the longest alignment there is."""
    rng = random.Random(12)
    for _ in range(300):
        a, b = ([rng.choice("abcdefgh"[: rng.randrange(2, 9)]) for _ in range(rng.randrange(0, 14))] for _ in range(2))
        pairs = licenses.align(a, b)
        _order_of(a, b, pairs)
        ends = [(-1, -1), *pairs, (len(a), len(b))]
        for (i, j), (k, m) in zip(ends, ends[1:]):
            assert not set(a[i + 1 : k]) & set(b[j + 1 : m])
        assert len(pairs) <= _longest(a, b)
    for _ in range(200):
        a, b = (rng.sample("abcdefghijklmnop", rng.randrange(0, 16)) for _ in range(2))
        pairs = licenses.align(a, b)
        _order_of(a, b, pairs)
        assert len(pairs) == _longest(a, b)


def test_every_place_of_a_template_is_found(session):
    rng = random.Random(5)
    isc, filler = licenses.TEMPLATES["ISC"], lambda n: " ".join(f"q{rng.randrange(10**6)}" for _ in range(n))
    rows = [
        (1, f"{isc} {filler(50)} {isc}"),
        (2, f"{filler(7)} {isc} {isc} {isc} {filler(3)} {licenses.TEMPLATES['BSD-2-Clause']} {filler(9)}"),
        (3, filler(500)),
        (4, f"{licenses.TEMPLATES['AGPL-3.0 header']} {licenses.TEMPLATES['LGPL-2.1 header']} {licenses.TEMPLATES['Unlicense']}"),
    ]
    got = {r.doc_id: r for r in licenses.scan_licenses(session.createDataFrame(rows, "doc_id long, text string")).collect()}
    n = len(licenses.words_of(isc))
    places = {i: [(x.license, x.start_word, x.end_word) for x in r.licenses if x.coverage > 0.99] for i, r in got.items()}
    assert places[1] == [("ISC", 0, n), ("ISC", n + 50, 2 * n + 50)]
    assert places[2][-3:] == [("ISC", 7 + n * k, 7 + n * (k + 1)) for k in range(3)]
    assert [x[0] for x in places[2][:-3]] == ["BSD-2-Clause"]
    assert places[3] == [] and got[3].license is None
    # (All words of the GPL's header stand in the Affero one as well.)
    assert {x[0] for x in places[4]} - {"GPL-3.0 header"} == {"AGPL-3.0 header", "LGPL-2.1 header", "Unlicense"}
    # Words put between others: as many as asked for.
    template = licenses.words_of(isc)
    apart = [x for w in template for x in (w, f"z{rng.randrange(10**6)}", "q1")]
    assert licenses.all_matches(apart, template, 0.8) == []
    assert licenses.all_matches(apart, template, 0.8, spread=3.0)[0][0] == 1.0


def test_places_equal_a_search_of_all_windows():
    """Brute force: the window at every template word, the best first, then both sides."""
    rng = random.Random(9)

    def brute(words, template, a, b):
        hits = []
        for s in (s for s in range(a, b) if words[s] in template):
            pairs = licenses.align(words[s : min(b, s + 2 * len(template))], template)
            if len(pairs) >= 0.8 * len(template):
                hits.append((-len(pairs), s + pairs[0][0], s + pairs[-1][0] + 1))
        if not hits:
            return []
        got = min(hits, key=lambda h: h[0])  # of equal ones the earliest window's
        return [*brute(words, template, a, got[1]), got, *brute(words, template, got[2], b)]

    for _ in range(40):
        template = [rng.choice("abcdefghij") for _ in range(rng.randrange(4, 9))]
        words = [rng.choice("abcdefghijkl") for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w for w in template if rng.random() < 0.95]
        want = [(-n / len(template), s, e) for n, s, e in brute(words, template, 0, len(words))]
        assert licenses.all_matches(words, template, 0.8) == want
