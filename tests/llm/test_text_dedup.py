import random

import pytest
from helpers import awkward, docs, frame, prose, unchanged

from tidemark.llm import lines, substring
from tidemark.llm.automaton import SuffixAutomaton


def slow_lines(texts):
    """{id: kept text} by the definition, in id order."""
    seen, out = set(), {}
    for doc, text in sorted(texts.items()):
        if text is None:
            out[doc] = None
            continue
        rows = text.split("\n")
        gone = set()
        for i in range(len(rows) - 2):
            w = tuple(rows[i:i + 3])
            if w in seen:
                gone.update((i, i + 1, i + 2))
            seen.add(w)
        out[doc] = "\n".join(x for i, x in enumerate(rows) if i not in gone)
    return out


def test_lines_equal_brute_force(spark):
    rnd = random.Random(1)
    texts = ["\n".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12))) for _ in range(40)]
    texts += ["a", "a\nb", "", None, "a\na\na\na\na\na", "\n\n\n\n\n"]
    got = {r.doc_id: r for r in lines.dedup_lines(docs(spark, texts)).collect()}
    want = slow_lines(dict(enumerate(texts)))
    assert {k: r.text for k, r in got.items()} == want
    for i, t in enumerate(texts):
        assert got[i].n_lines == (0 if t is None else t.count("\n") + 1)
        if t and got[i].n_removed < got[i].n_lines:
            assert got[i].n_removed == t.count("\n") - want[i].count("\n")


def test_lines_awkward_rows(spark):
    base = awkward(spark, docs(spark, ["a\nb\nc\nd", "x\na\nb\nc"]))
    out = lines.dedup_lines(base)
    assert out.columns == [*base.columns, "n_lines__", "n_removed_"]  # the input has n_lines, n_lines_ and n_removed
    rows = out.collect()
    assert len(rows) == base.count() and unchanged(rows, base)
    assert {r.text for r in rows if r.doc_id == 0} == {"a\nb\nc\nd"}  # read twice, kept twice
    assert [r.text for r in rows if r.doc_id == 1] == ["x"]
    assert lines.dedup_lines(base.limit(0)).count() == 0


def slow_words(texts, window):
    first, out = {}, {}
    for doc, text in sorted(texts.items()):
        words = (text or "").encode().split()
        gone = set()
        mine = set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            mine.add(w)
            if w in first:
                gone.update(range(i, i + window))
        for w in mine:
            first.setdefault(w, doc)
        out[doc] = (len(words), len(gone), b" ".join(x for i, x in enumerate(words) if i not in gone).decode())
    return out


def as_dict(df):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in df.collect()}


@pytest.mark.parametrize("window", [13, 3])
def test_substrings_equal_brute_force(spark, window):
    texts = [*prose(7, 120, vocabulary=8 if window == 13 else 30), None, "", "one", "é \t b\x0b c\x0c d\r\n e " * 12]
    rows = substring.dedup_substrings(docs(spark, texts), window)
    want = slow_words(dict(enumerate(texts)), window)
    assert as_dict(rows) == want
    assert sum(x[1] for x in want.values()) > 50
    for r in rows.collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed


def test_substrings_over_many_pieces_shards_and_parts(spark, monkeypatch):
    """Long references are cut, shards are many, and readers are split."""
    monkeypatch.setattr(substring, "SHARD_WORDS", 20)
    monkeypatch.setattr(substring, "PART_BYTES", 2000)
    monkeypatch.setattr(substring, "IN_BATCH", 8)
    monkeypatch.setattr(substring, "BUCKET_WORDS", 10)
    passage = " ".join("p%d" % i for i in range(30))
    texts = [t + " " + passage for t in prose(9, 60, words=(30, 90))]
    assert as_dict(substring.dedup_substrings(docs(spark, texts), 5)) == slow_words(dict(enumerate(texts)), 5)


def test_buckets_grow_with_the_words(spark, monkeypatch):
    """No size at which buckets stop growing in number: here over 4,096, and more than tasks."""
    assert substring._bucket_bits(10 ** 14) == 26 and substring._unused_bits(26) == 0
    monkeypatch.setattr(substring, "BUCKET_WORDS", 1)
    monkeypatch.setattr(substring, "TARGETS", 2)
    monkeypatch.setattr(substring, "PART_BYTES", 4000)
    texts = prose(31, 400, vocabulary=12, words=(10, 90))
    words = sum(len(t.encode()) for t in texts) // 5
    assert substring._bucket_bits(words) > 12
    assert as_dict(substring.dedup_substrings(docs(spark, texts), 7)) == slow_words(dict(enumerate(texts)), 7)
    monkeypatch.setattr(substring, "STORED", 8)  # as beyond 2^24 buckets: bucket and stored bytes share bits
    assert as_dict(substring.dedup_substrings(docs(spark, texts), 7)) == slow_words(dict(enumerate(texts)), 7)


@pytest.mark.parametrize("slice_size", [1 << 20, 2000])
def test_substrings_where_hashes_collide(spark, monkeypatch, slice_size):
    """With hashes of 14 bits different windows share one; the words decide."""
    monkeypatch.setattr(substring, "STORED", 1)
    monkeypatch.setattr(substring, "IN_BATCH", 8)
    monkeypatch.setattr(substring, "PART_BYTES", 20000)
    monkeypatch.setattr(substring, "DOUBT_SLICE", slice_size)
    rnd = random.Random(21)
    word = lambda: "u%d" % rnd.randrange(10 ** 9)
    passages = [" ".join(word() for _ in range(5)) for _ in range(300)] * 2  # each in two documents only
    texts = [" ".join([*(word() for _ in range(10)), p, *(word() for _ in range(10))]) for p in passages]
    rows = substring.dedup_substrings(docs(spark, texts), 5)
    assert as_dict(rows) == slow_words(dict(enumerate(texts)), 5)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in rows.collect())


def test_substrings_awkward_rows(spark):
    text = " ".join("w%d" % i for i in range(20))
    base = awkward(spark, docs(spark, [text, "a " + text, text]))
    rows = substring.dedup_substrings(base, 13).collect()
    assert len(rows) == base.count()
    assert {(r.doc_id, r.kept) for r in rows if r.doc_id in (0, 1, 2)} == {(0, text), (1, "a"), (2, "")}
    assert [(r.n_words, r.n_removed) for r in rows if r.doc_id == 902] == [(30000, 0)]
    assert [r.kept for r in rows if r.doc_id is None] == ["no id"]
    assert substring.dedup_substrings(frame(spark, []), 13).count() == 0


def test_automaton_equals_scan():
    rnd = random.Random(8)
    for _ in range(60):
        refs = [[b"%d" % rnd.randrange(3) for _ in range(rnd.randint(0, 25))] for _ in range(rnd.randint(1, 5))]
        a = SuffixAutomaton(4)
        for i, words in enumerate(refs):
            a.add(words, i * 10)
        a.close()
        text = [b"%d" % rnd.randrange(4) for _ in range(40)]
        for doc in (0, 10, 25, 100):
            gone = set()
            for i in range(len(text) - 3):
                if any(refs[r][j:j + 4] == text[i:i + 4] for r in range(len(refs)) if r * 10 < doc
                       for j in range(len(refs[r]) - 3)):
                    gone.update(range(i, i + 4))
            spans = a.covered(text, doc)
            assert {i for s, e in spans for i in range(s, e)} == gone
            assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
