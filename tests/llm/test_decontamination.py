"""Words and keys of the decontamination."""

import re
import time

from pyspark.sql import functions as F

from tallyfold.llm import contamination

WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def test_words_at_every_kind_of_character(session):
    codes = [*range(0x3400), *range(0xD700, 0xD800), *range(0xE000, 0xE100), *range(0xFE00, 0x10100), 0x1F600, 0x2FA1D, 0x10FFFF]
    texts = [f"{chr(c)}one{chr(c)}{chr(c)}Two 3{chr(c)}" for c in codes] + ["", " ", None, "".join(map(chr, codes))]
    rows = session.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", contamination.words(F.col("t")).alias("w"))
    got = {r.i: r.w for r in rows.collect()}
    assert [got[i] for i in range(len(texts))] == [WORD.findall(t or "") for t in texts]


def test_words_cost_less_than_by_ranges(session):
    """The same words by a pattern of ranges take several times as long."""
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: F.sha2((i * 7 + F.col("id")).cast("string"), 256)))
    docs = session.range(0, 600, numPartitions=2).select(text.alias("t")).localCheckpoint()
    ranges = F.regexp_extract_all("t", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))

    def seconds(column):
        began = time.perf_counter()
        assert docs.select(F.sum(F.size(column))).first()[0] == 600_000
        return time.perf_counter() - began

    took = [(seconds(contamination.words(F.col("t"))), seconds(ranges)) for _ in range(4)]
    assert min(x for x, _ in took) < 0.6 * min(y for _, y in took), took


def test_words_of_one_key_are_told_apart(session, monkeypatch):
    """Were all words of one length to share a key, nothing would change."""
    monkeypatch.setattr(contamination, "_key", lambda word: F.xxhash64(F.length(word)))
    docs = [(1, "aa bb cc dd"), (1, "aa bb cc dd"), (2, "AA bb xx dd"), (3, "xx aa BB cc"), (None, "cc bb aa"), (4, None)]
    items = [(7, "aa bb cc"), (8, "zz bb"), (9, "bb CC dd")]
    found = contamination.contamination(session.createDataFrame(docs, "doc_id long, text string"), session.createDataFrame(items, "item_id long, text string"))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect())
    assert got == [("1", 4, 4, ("7", "9")), ("1", 4, 4, ("7", "9")), ("2", 4, 0, ()), ("3", 4, 3, ("7",)), ("4", 0, 0, ()), ("None", 3, 0, ())]
