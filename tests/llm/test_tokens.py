"""Token ids, packing and counts that follow edits, against the tokenizer itself."""

import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakepnl.llm import packing, queries, token_tree, tokens
from lakepnl.llm.packing import filled_bins
from lakepnl.llm.text import slices
from lakepnl.llm.tokens import Encoder, units
from lakepnl.llm.token_tree import _edited

PATH = queries.tokenizer_path()
ODD = [
    "a   b", "a\n \n b  ", "  x\t\ty   z", "<|endoftext|> hi<|endoftext|>", "it's  'll don't   \n\n  we've", "\x1c \x1d a\x1eb",
    "  ", "", " ", "é ñ 　 x", "　 x  y  z", "a  b.,c),. é.è,", "x',s 3,4 )., ÷. ×,", " \n x", "雪. \U0001f600,",
]
chars = st.sampled_from(list("ab1.,'é÷ \n\t 　 雪-"))


@pytest.fixture(scope="module")
def model():
    return Encoder(PATH)


def ids_of(model, texts):
    made = []
    for _, _, data, offsets in slices(pa.record_batch([pa.array(texts, pa.string())], ["text"])):
        ids, at = model.ids(data, offsets)
        made += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    return made


def test_units_give_the_ids_of_whole_texts(model, small):
    texts = ODD + [r["text"] for r in small.select("text").collect()]
    assert ids_of(model, texts) == [model.encode(t) for t in texts]


def test_units_are_stored_in_order_and_once(small, monkeypatch):
    """op2: known units are found in sorted arrays, not one by one; the store may be emptied at any time."""
    texts = [r["text"] for r in small.select("text").limit(60).collect()] + ODD
    model, asked = Encoder(PATH), []
    want = [model.encode(t) for t in texts]
    learn = model._learn
    model._learn = lambda keys, new: (asked.extend(new), learn(keys, new))[1]
    for _ in range(2):
        assert [ids_of(model, [t])[0] for t in texts] == want
    assert len(asked) == len(set(asked)) == len(model.keys) > 0
    assert isinstance(model.keys, np.ndarray) and (np.diff(model.keys.astype(object)) > 0).all()
    monkeypatch.setattr(tokens, "STORED", 50)
    assert [ids_of(model, [t])[0] for t in texts] == want


@settings(max_examples=300, deadline=None)
@given(st.lists(chars, max_size=30).map("".join))
def test_units_of_any_text(text):
    model = test_units_of_any_text.__dict__.setdefault("model", Encoder(PATH))
    assert ids_of(model, [text]) == [model.encode(text)]
    data = np.frombuffer(text.encode(), np.uint8)
    if len(data):
        found = units(data, np.array([0, len(data)]))
        assert (found.start[1:] == found.end[:-1]).all() and found.end[-1] == len(data)


def test_bins_use_every_piece_once_and_few_sequences():
    rng = random.Random(1)
    counts = Counter(min(1023, int(rng.paretovariate(0.9) * 9)) for _ in range(20_000))
    bins = filled_bins(counts, 1024)
    used = Counter()
    for own, times in bins:
        assert sum(own) <= 1024 and times > 0
        for length in own:
            used[length] += times
    assert used == counts
    least = -(-sum(k * n for k, n in counts.items()) // 1024)
    assert sum(t for _, t in bins) <= least * 1.01 + 1


def test_two_for_the_smallest():
    """Greedy takes 6 and 3 and leaves one; 2 and 2 in place of the 3 fill the bin."""
    assert filled_bins({6: 1, 3: 1, 2: 2}, 10) == [([6, 2, 2], 1), ([3], 1)]
    assert filled_bins({}, 10) == []


def best_fit_decreasing(lengths, capacity=1024):
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - length)
    return len(gaps)


def check_packing(rows, texts, model, capacity=1024):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for doc_id, text in texts.items():
        ids = [*model.encode(text or ""), 2]
        own = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // capacity)))
        at = 0
        for r in own:
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids) and all(r["length"] == capacity for r in own[1:])
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packed_table(spark, sf, small, model):
    rows = queries.QUERIES["op2_best_fit_packing"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] for r in small.collect()}
    n = check_packing(rows, texts, model)
    assert n <= best_fit_decreasing([r["length"] for r in rows])


def test_packing_of_odd_rows(odd_docs, no_docs, model):
    rows = packing.pack_documents(odd_docs, PATH).collect()
    assert Counter(r["doc_id"] for r in rows)[1] == 2
    texts = {r["doc_id"]: r["text"] for r in odd_docs.collect() if r["doc_id"] != 1}
    check_packing([r for r in rows if r["doc_id"] == 5], {5: texts[5]}, model)
    assert sorted(r["length"] for r in rows if r["doc_id"] in (2, 3)) == [1, 1]
    assert packing.pack_documents(no_docs, PATH).count() == 0
    assert len(packing.pack(packing.pieces(odd_docs, PATH)).collect()) == len(rows)


def applied(text, edits):
    for first, last, new in sorted(edits, key=lambda e: -e[0]):
        text = text[:first] + new + text[last:]
    return text


def stored(model, text):
    data = np.frombuffer(text.encode(), np.uint8)
    found = units(data, np.array([0, len(data)]))
    return {
        "bytes": (found.end - found.start).astype("<u4").tobytes(),
        "tokens": model.counts(found).astype("<u4").tobytes(),
    }


@settings(max_examples=300, deadline=None)
@given(st.lists(chars, max_size=400).map("".join), st.data())
def test_edited_counts(text, data):
    model = test_units_of_any_text.__dict__.setdefault("model", Encoder(PATH))
    cuts = sorted(data.draw(st.lists(st.integers(0, len(text)), max_size=6)))
    edits = [(a, b, data.draw(st.lists(chars, max_size=5).map("".join))) for a, b in zip(cuts[::2], cuts[1::2])]
    edits = [e for k, e in enumerate(edits) if not k or e[0] > edits[k - 1][0]]
    rows = [dict(zip(("first", "last", "new"), e)) for e in edits]
    got = _edited(text, len(model.encode(text)), stored(model, text), rows, model)
    want = applied(text, edits)
    assert got[0] == want
    assert got[4] == len(model.encode(want))


def test_few_units_are_encoded_again(model):
    text = "some plain words, and more of them. " * 2_000
    got = _edited(text, 0, stored(model, text), [{"first": 30_000, "last": 30_003, "new": "xyz"}], model)
    assert got[6] <= 6 and got[4] == len(model.encode(got[0]))


def test_documents_of_a_batch_are_edited_side_by_side(model):
    """op8: the store is asked once for the next edit of all documents, with the rows of one document at a time."""
    texts = [None, "", *(f"some plain words {k}, and  more of them. é雪 " * (k % 90) + "x" * k for k in range(200)), *ODD]
    edits = []
    for n in (len(t or "") for t in texts):
        spans = [(n * k // 4, min(n * k // 4 + k, n * (k + 1) // 4)) for k in range(4)]
        edits.append([{"first": a, "last": b, "new": f"<{k}'s "} for k, (a, b) in enumerate(spans)])
    edits[3], edits[4] = None, [{"first": 2, "last": 2, "new": "a b"}, {"first": 2, "last": 2, "new": None}]
    rows = [(t, 7, stored(model, t or ""), e) for t, e in zip(texts, edits)]
    want, asked = [_edited(*row[:3], row[3] or [], model) for row in rows], []
    counts = model.counts
    model.counts = lambda found: (asked.append(len(found.start)), counts(found))[1]
    try:
        assert token_tree._edited_rows(rows, model) == want
    finally:
        model.counts = counts
    assert len(asked) <= 4
    for (text, _, _, changes), got in zip(rows, want):
        assert got[4] == len(model.encode(got[0] or "")) and got[3] == 7
        assert changes is None or got[0] == applied(text or "", [(e["first"], e["last"], e["new"] or "") for e in changes])


def test_counts_of_the_table(spark, sf, small, model):
    got = {r["doc_id"]: r for r in queries.QUERIES["op8_token_counts"](spark, sf).collect()}
    edits = small.select("doc_id", "text", token_tree.sample_edits().alias("edits")).collect()
    assert len(got) == len(edits)
    for row in edits:
        want = applied(row["text"], [(e["first"], e["last"], e["new"]) for e in row["edits"]])
        assert got[row["doc_id"]]["n_before"] == len(model.encode(row["text"]))
        assert got[row["doc_id"]]["n_tokens"] == len(model.encode(want))


def test_trees_of_odd_rows(odd_docs, no_docs):
    trees = token_tree.build(odd_docs, PATH)
    got = token_tree.apply_edits(trees.withColumn("edits", token_tree.sample_edits()), PATH).collect()
    assert len(got) == odd_docs.count() and "n_words" in got[0]
    plain = token_tree.apply_edits(trees.selectExpr("*", "CAST(NULL AS array<struct<first:long,last:long,new:string>>) AS edits"), PATH)
    assert all(r["n_before"] == r["n_tokens"] for r in plain.collect())
    assert token_tree.build(no_docs, PATH).count() == 0
