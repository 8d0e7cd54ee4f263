"""Hard negatives, mixing and fill-in-middle."""

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from compare import difference
from lakepnl.llm import fill_middle, hard_negatives, mixing, queries
from lakepnl.llm.fill_middle import DEFAULT, fill_in_middle, invert, restore, transform

VECTORS = "vec_id long, label int, embedding array<double>, score string"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_fill_in_middle"])
def test_query_against_sql(spark, sf, name):
    rows, problem = difference(spark, sf, queries.QUERIES[name], queries.ORACLES[name])
    assert not problem and rows > 0


# Hard negatives


def plain_negatives(rows, every=100):
    """All scores of all pairs, row by row, in whole numbers."""
    own = []
    for i, (vec_id, label, vector, _) in enumerate(rows):
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            own.append((i, vec_id, label, [math.floor(256 * x) for x in vector]))

    def order(found):
        return sorted(found, key=lambda f: (-f[0], f[1] is None, f[1] or 0))

    out = []
    for i, anchor, label, a in own:
        if anchor is None or anchor % every:
            continue
        scores = [(sum(x * y for x, y in zip(a, v, strict=False)), o, other) for j, o, other, v in own if j != i]
        positives = order((s, o) for s, o, other in scores if other == label)[:5]
        for high, positive in positives:
            window = order((s, o) for s, o, other in scores if other != label and 30 * high <= 100 * s <= 90 * high)
            out += [(anchor, positive, rank, o, high, s) for rank, (s, o) in enumerate(window[:10], 1)]
    return sorted(out, key=str)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    got = hard_negatives.hard_negatives(df, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (5, 2), (4, 1)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
        keys = [k.tobytes() for k in hard_negatives.hilbert_keys(points, bits)]
        assert len(set(keys)) == len(points)
        along = points[np.array(sorted(range(len(keys)), key=keys.__getitem__))]
        assert (np.abs(np.diff(along, axis=0)).sum(1) == 1).all()


def test_negatives_of_clusters_ties_and_odd_rows(spark):
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(6, 8))
    rows = []
    for i in range(900):
        vector = centres[i % 6] + 0.2 * draw.normal(size=8)
        rows.append((i, int(draw.integers(0, 4)), vector.tolist(), "clash"))
    rows += [(2000 + i, i % 3, [0.5] * 8, None) for i in range(200)]  # one vector, many ids
    rows += [(100, 1, [0.5] * 8, None)] * 70  # repeated rows, more than a block holds
    rows += [
        (3000, None, [1.0] * 8, None), (3100, 1, None, None), (3200, 1, [1.0, None] + [0.0] * 6, None),
        (3300, 1, [math.nan] * 8, None), (3400, 1, [math.inf] * 8, None), (None, 1, [0.4] * 8, None),
        (None, 2, [0.45] * 8, None), (3500, 2, [], None), (3600, 2, [1.0, 2.0], None), (3700, 9, [3.0] * 8, None),
    ]
    want = plain_negatives(rows)
    assert mined(spark, rows) == want and len(want) > 1000
    assert mined(spark, rows, batch=5) == want


def test_large_components_are_exact(spark):
    draw = np.random.default_rng(4)
    rows = [(i * 50, i % 3, (30_000 * draw.normal(size=4)).round(3).tolist(), None) for i in range(60)]
    rows = [(i, label, [max(-60_000.0, min(60_000.0, x)) for x in v], c) for i, label, v, c in rows]
    assert mined(spark, rows) == plain_negatives(rows)


def test_zone_maps_leave_parts_out(spark):
    """Far clusters of one label each: an anchor's positives lie in few parts, and no other part is read."""
    draw = np.random.default_rng(5)
    rows = [(i, i % 8, (np.eye(8)[i % 8] * 5 + 0.1 * draw.normal(size=8)).tolist(), None) for i in range(4000)]
    df = spark.createDataFrame(rows, VECTORS).selectExpr("vec_id", "label * 1L as label", "embedding")
    space = hard_negatives._space(df, 256)
    blocks = hard_negatives.build_blocks(df, space, 256, (200, 400))
    one = hard_negatives._anchors(blocks, space, 100, 5).where("vec_id = 800").toArrow()
    anchors = hard_negatives.Anchors(
        *[one.column(c).to_numpy() for c in ("vec_id", "label")],
        np.frombuffer(one.column("vector")[0].as_py(), space.stored).reshape(1, -1).astype(space.exact),
        *[one.column(c).to_numpy() for c in ("block", "pos")],
        one.column("reached").to_numpy()[:, None],
        np.full((1, 1), 1 << 62),
    )
    found = hard_negatives._needed(blocks, anchors, space, True)
    assert 0 < found.count() < blocks.count() / 3
    labels = {r["label"] for r in found.select("label").distinct().collect()}
    assert 0 in labels and len(labels) <= 2  # a part may end within the next label
    assert blocks.selectExpr("sum(n)").first()[0] == 4000


def test_no_vectors(spark):
    assert mined(spark, [(None, None, None, None)]) == []
    assert mined(spark, [(1, 1, [1.0], None), (2, 1, [1.0], None)]) == []
    assert mined(spark, [(100, 1, [1.0], None)]) == []
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.hard_negatives(none).collect() == []


# Mixing


def plain_targets(sizes):
    """Shares of all words by weight, the excess dealt out again until nothing is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        open_ones = [s for s in names if s not in full]
        rest = total - sum(3 * sizes[s] for s in full)
        share = {s: weight[s] * rest / sum(weight[o] for o in open_ones) for s in open_ones}
        above = [s for s in open_ones if share[s] > 3 * sizes[s]]
        if not above:
            return share | {s: 3.0 * sizes[s] for s in full}
        full |= set(above)


def checked_mix(docs, tolerance):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
    want = plain_targets(sizes)
    for source, target in targets.items():
        assert target == pytest.approx(want[source], rel=1e-12)
        assert abs(taken[source] - target) <= tolerance, (source, taken[source], target)
    return sorted((tuple(r) for r in rows), key=str)


def test_mix_of_the_table(spark, small):
    """Targets are met to a few words, and the sample does not follow the layout of the table."""
    first = checked_mix(small, 210)
    assert checked_mix(small.repartition(7), 210) == first
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in small.collect()}
    assert all(sizes[r[0]] == r[2] for r in first)


def test_order_is_that_of_pareto_sampling(spark, small):
    """The same plan, filled document by document in the order of the odds."""
    rows = mixing.sized(small).withColumn("copy", mixing.F.lit(0).cast("long"))
    rows = mixing.saved(rows.withColumn("draw", mixing.F.xxhash64("row", "copy")), "t")
    sources = mixing.saved(mixing.source_targets(rows), "t")
    plan = mixing.expected_copies(rows, sources)
    plans = {(r["name"], r["class"]): r for r in plan.collect()}
    budget = defaultdict(float)
    for (name, _), r in plans.items():
        budget[name] = r["target"] - (r["target"] - budget[name] if budget[name] else 0) - r["whole"] * r["words"]
        assert 0 <= r["whole"] <= 3 and 0 <= r["fraction"] < 1
    for name in budget:
        own = [r for (n, _), r in plans.items() if n == name]
        assert sum((r["whole"] + r["fraction"]) * r["words"] for r in own) == pytest.approx(own[0]["target"], rel=1e-9)
    ranked = []
    for r in rows.where("size > 0").collect():
        p = plans[r["name"], r["class"]]["fraction"]
        if p > mixing.EDGE:
            u = ((r["draw"] % (1 << 64) >> 12) + 0.5) / (1 << 52)
            ranked.append(((u / (1 - u)) / (p / (1 - p)), r["doc_id"], r["name"], r["size"]))
    left = {n: math.floor(t["target"] - sum(r["whole"] * r["words"] for (m, _), r in plans.items() if m == n) + 0.5)
            for (n, _), t in plans.items()}
    chosen = set()
    for _, doc_id, name, size in sorted(ranked):
        if size <= left[name]:
            left[name] -= size
            chosen.add(doc_id)
    found = rows.collect()
    want = {r["doc_id"]: (plans[r["name"], r["class"]]["whole"] if r["size"] else 0) + (r["doc_id"] in chosen) for r in found}
    for name, words in left.items():
        own = [r for r in found if r["name"] == name and r["size"] and want[r["doc_id"]] < 3]
        near = min(((abs(words - r["size"]), r["size"], r["draw"], r["doc_id"]) for r in own), default=(words,))
        if near[0] < words:
            want[near[3]] += 1
    assert {r["doc_id"]: r["copies"] for r in mixing.mix(small).collect()} == want


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    checked_mix(odd_docs, 60_000)
    assert mixing.mix(no_docs).collect() == []
    # One row in great number, in a hot source, and sources whose limit is below their share.
    hot = spark.range(3000).selectExpr("7L as doc_id", "'a b c d' as text", "'hot' as source", "1 as size")
    few = spark.createDataFrame([(1, "x y", "a", 0), (2, "z", None, 0), (3, " ", "b", 0), (4, None, "c", 0)], "doc_id long, text string, source string, size int")
    both = hot.unionByName(few)
    first = checked_mix(both, 4)
    assert checked_mix(both.repartition(6), 4) == first


# Fill-in-middle


def plain_fim(text, doc_id):
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab Z\n\t<PSM>é雪\U0001f600İ\x00[`{@")), st.one_of(st.none(), st.integers(-5, 10**12)))
def test_rotations(text, doc_id):
    got = transform(text.encode(), doc_id)
    assert (*got[:4], got[4].decode()) == plain_fim(text, doc_id)
    assert invert(got[4], got[1]).decode() == text


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.data())
def test_three_reversals(data, draw):
    cuts = sorted(draw.draw(st.lists(st.integers(0, len(data)), min_size=3, max_size=3)))
    view = np.frombuffer(bytearray(data), np.uint8)
    fill_middle.rotate(view, *cuts)
    a, b, c = cuts
    assert view.tobytes() == data[:a] + data[b:c] + data[a:b] + data[c:]


def test_fim_of_odd_rows(spark, odd_docs, no_docs):
    clash = odd_docs.withColumnsRenamed({"n_words": "output", "lang": "form"})
    for docs in (odd_docs, clash, odd_docs.withColumnRenamed("lang", "restored")):
        got = restore(fill_in_middle(docs)).collect()
        assert len(got) == docs.count()
        for r in got:
            want = plain_fim(r["text"] or "", r["doc_id"])
            assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
            assert r["restored"] == (r["text"] or "")
    assert restore(fill_in_middle(no_docs)).collect() == []
    marked = spark.createDataFrame([(i, f"a <{x}> b") for i, x in enumerate("PSMX" * 20)], "doc_id long, text string")
    forms = defaultdict(set)
    for r in fill_in_middle(marked).collect():
        forms[r["text"][3]].add(r["form"])
    assert forms["P"] == forms["S"] == forms["M"] == {"plain"} and forms["X"] == {"plain", "psm", "spm"}
    assert DEFAULT.sentinels == (b"<P>", b"<S>", b"<M>")
