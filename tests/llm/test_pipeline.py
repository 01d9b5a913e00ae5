"""The corpus pipeline, stage by stage, against brute force."""

import random
import uuid
from collections import Counter

import pytest

import corpus_pipeline
from tallyfold.llm import jaccard, rules, secret_scan
from tests.llm.test_joins import _contaminated, _groups, words
from tests.llm.test_counts import _stats


@pytest.fixture(scope="session")
def folder(session, tmp_path_factory, corpus):
    rng = random.Random(3)
    path = str(tmp_path_factory.mktemp("tables"))
    rows = [(i * 10 + 1, t, "en", f"s{i % 3}", len(t or "")) for i, (_, t) in enumerate(corpus)]
    long = [t for _, t, *_ in rows if t and len(words(t)) > 60]
    rows += [(5000 + i, f"password=abcdefgh{i} " + " ".join(f"z{rng.randrange(900)}" for _ in range(80)), "en", None, 0) for i in range(9)]
    rows += [(6000 + i, " ".join(f"##y{rng.randrange(900)}" for _ in range(80)), "en", "s1", 0) for i in range(120)]
    rows += [(7000 + i, " ".join(f"q{rng.randrange(900)}" for _ in range(80)), "en", "s1", 0) for i in range(120)]
    rows += [(8000, None, None, None, None), (9001, rows[-1][1], "en", "s2", 3)]
    items = [(i, " ".join(words(rng.choice(long))[3:25])) for i in range(4)]
    labels = [(6000 + i, 0, 0) for i in range(100)] + [(7000 + i, 1, 0) for i in range(100)]
    session.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    session.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    session.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, items


def test_stages(session, folder):
    path, rows, items = folder
    docs = session.read.parquet(f"{path}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    take = lambda df: [tuple(r) for r in df.select("doc_id", "text").collect()]

    kept = stages["quality rules"](session, docs, path).cache()
    assert kept.columns == docs.columns
    learned = rules.fit_rules(docs, session.read.parquet(f"{path}/labels.parquet"))
    assert learned
    failed = lambda t: (s := _stats(t))[0] < 20 or 100 * s[4] > 30 * s[0]
    got = Counter(take(kept))
    assert got == Counter((d, t) for d, t, *_ in rows if not failed(t) and not (t or "").startswith("##"))

    one = stages["n-gram Jaccard join"](session, kept, path).cache()
    assert one.columns == docs.columns
    before = take(kept)
    groups = _groups(before)
    assert Counter(d for d, _ in take(one)) == Counter(dict.fromkeys((g for _, _, g in groups), 1))

    clean = stages["benchmark decontamination"](session, one, path).cache()
    assert clean.columns == docs.columns
    hit = {d for (d, _, n, _), _ in _contaminated([(d, t or "") for d, t in take(one)], items).items() if n}
    assert hit and Counter(take(clean)) == Counter((d, t) for d, t in take(one) if d not in hit)

    safe = stages["secret scans"](session, clean, path).cache()
    assert safe.columns == docs.columns
    want = Counter((d, secret_scan.redact(t, secret_scan.find_secrets(t)[1])) for d, t in take(clean))
    assert Counter(take(safe)) == want and any("[SECRET]" in t for _, t in want)
    assert all(r.n_chars == len(r.text) for r in safe.collect())

    mixed = stages["source mixing"](session, safe, path)
    assert mixed.count() == safe.count()
    assert Counter(take(corpus_pipeline.run(session, path))) == Counter(take(safe))


def test_keep_one_with_repeated_rows_nulls_and_empty(session, empty):
    text = "a b c d e f g h i j"
    rows = [(5, text), (5, text), (9, text), (None, text), (1, None), (1, None), (2, ""), (None, "x y z x y z"), (None, "x y z x y z")]
    df = session.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in jaccard.keep_one(df).collect())
    assert got == Counter([(5, text), (1, None), (1, None), (2, ""), (None, "x y z x y z")])
    assert jaccard.keep_one(empty).count() == 0
    for name, stage in corpus_pipeline.STAGES[3:]:
        assert stage(session, empty, "").count() == 0, name


def test_a_broken_run_goes_on_where_it_stopped(session, folder, monkeypatch):
    path, *_ = folder
    calls, broken = Counter(), [True]

    def counted(name, stage):
        def run(spark, docs, sf_dir):
            calls[name] += 1
            if name == "secret scans" and broken[0]:
                raise RuntimeError("lost")
            return stage(spark, docs, sf_dir)

        return run

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, counted(n, f)) for n, f in corpus_pipeline.STAGES])
    name = f"test-{uuid.uuid4().hex[:8]}"
    with pytest.raises(RuntimeError, match="lost"):
        corpus_pipeline.run(session, path, resume=name)
    broken[0] = False
    got = corpus_pipeline.run(session, path, resume=name)
    assert calls == {"quality rules": 1, "n-gram Jaccard join": 1, "benchmark decontamination": 1, "secret scans": 2, "source mixing": 1}
    rows = lambda df: Counter((r.doc_id, r.text, r.mix_slot, r.mix_offset) for r in df.collect())
    assert rows(got) == rows(corpus_pipeline.run(session, path, resume=name))
    assert sum(calls.values()) == 6  # all stages read back
    assert rows(got) == rows(corpus_pipeline.run(session, path))
