"""Near-duplicates, decontamination, line spread, quality, language model and personal data."""

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakepnl.llm import decontaminate, line_spread, pitman_yor, quality, queries, sanitise, simhash
from lakepnl.llm.text import saved

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    words = WORD.findall((text or "").translate(AZ))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance=2):
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in ids}


def test_simhash_of_the_table(spark, sf, small):
    prints = {r["doc_id"]: plain_fingerprint(r["text"]) for r in small.collect()}
    want = plain_components(prints)
    got = queries.QUERIES["op9_simhash_near_dedup"](spark, sf).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in got} == {
        i: (f"{prints[i]:016x}", want[i]) for i in prints
    }


@pytest.mark.parametrize("segments", [8, 12])
def test_links_miss_nothing(spark, segments):
    rng = random.Random(segments)
    centers = [rng.getrandbits(64) for _ in range(20)] + [0, (1 << 64) - 1]
    prints = set(centers)
    for c in centers:
        for _ in range(12):
            flipped = c
            for _ in range(rng.randint(1, 4)):
                flipped ^= 1 << rng.randrange(64)
            prints.add(flipped)
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in prints]
    got = simhash.links(spark.createDataFrame(signed, "simhash long"), 2, segments).collect()
    mask = (1 << 64) - 1
    found = {frozenset((r["a"] & mask, r["b"] & mask)) for r in got}
    want = {frozenset((a, b)) for a in prints for b in prints if a != b and (a ^ b).bit_count() <= 2}
    assert found == want and len(simhash.half_ball(8, 2)) == 73


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 50)] + [(300, 299), (5, 5)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = dict.fromkeys(range(41), 0) | dict.fromkeys(range(100, 150), 100) | {299: 299, 300: 299}
    assert got == want
    assert simhash.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add((r["simhash"], r["component_id"]))
    assert by_id[2] == by_id[3] == by_id[6] == {(0, 2)} and len(by_id[1]) == 1
    assert simhash.near_duplicates(no_docs).count() == 0


CONTRACT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_overlap(text, items):
    words = CONTRACT_WORD.findall((text or "").translate(AZ))
    hit, found = set(), set()
    for item_id, item in items:
        own = CONTRACT_WORD.findall((item or "").translate(AZ))
        k = min(13, len(own))
        windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for p in range(len(words) - k + 1):
            if tuple(words[p : p + k]) in windows:
                hit |= set(range(p, p + k))
                found.add(None if item_id is None else str(item_id))
    return len(words), len(hit), sorted(found, key=lambda i: (i is None, i or ""))


@pytest.mark.parametrize("block", [16 << 20, 700])
def test_overlaps_against_windows(spark, monkeypatch, block):
    """Also with the benchmark in many blocks."""
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rng = random.Random(3)
    vocabulary = ["a", "b", "Été", "the", "x1"]
    items = [(k, " ".join(rng.choices(vocabulary, k=n))) for k, n in enumerate([1, 2, 5, 12, 13, 14, 20, 40, 60, 13])]
    items += [(50, items[6][1]), (51, None), (52, " ,; "), (53, "the the the " * 9), (None, "a b")]
    docs = []
    for k in range(60):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 2)):
            own = rng.choice([t for i, t in items if t and i is not None]).split()
            a = rng.randrange(len(own))
            parts += [", ".join(own[a : a + rng.randint(1, 30)]), rng.choice(vocabulary)]
        docs.append((k, "; ".join(parts).upper() if k % 3 else " ".join(parts), "clash"))
    docs += [(100, None, "x"), (101, "", "x"), (102, "the " * 3000, "x"), (7, docs[7][1], "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, hits string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.overlaps(df, bench).select("*", decontaminate.item_ids().alias("ids")).collect()
    assert len(got) == len(docs)
    for row in got:
        assert (row["n_words"], row["n_hit"], row["ids"]) == plain_overlap(row["text"], items)
    assert decontaminate.overlaps(df.where("false"), bench).count() == 0
    assert sum(r["n_hit"] for r in decontaminate.overlaps(df, bench.where("false")).collect()) == 0


def test_line_spread_near_and_far_of_the_threshold(spark):
    rows = []
    for n_sites in (1, 3, 4, 5, 6, 7, 8, 9, 40):
        for k in range(n_sites):
            rows.append((len(rows), f"own first line of many words {len(rows)}\n  line on {n_sites} sites \n\nown last {len(rows)}", f"s{k}", "c"))
    rows += [(2000, None, "s1", "c"), (2001, "", None, "c"), (2002, "\n\n", "s1", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copied string")
    got = {r["doc_id"]: r for r in line_spread.without_boilerplate(df).collect()}
    assert len(got) == len(rows)
    for doc_id, text, *_ in rows:
        gone = re.search(r"line on (5|6|7|8|9|40) sites", text or "")
        want = text if not gone else "\n".join(x for x in text.split("\n") if "line on" not in x)
        assert got[doc_id]["text"] == want and got[doc_id]["n_removed"] == bool(gone)
        assert got[doc_id]["copied"] is False
    assert line_spread.without_boilerplate(df.where("false")).count() == 0


def test_line_spread_of_short_lines_footers_and_copies(spark):
    """Lines of any length and script go, from pages that hold little else too; copied texts are no boilerplate."""
    footer = "\n".join(f"footer line {k} of the network" for k in range(10))
    rows = [(k, f"Read more\n本网站的所有内容均受版权保护。\nown text {k} of this page", f"s{k}") for k in range(40)]
    rows += [(100 + k, f"own line {k}\n{footer}", f"s{k % 8}") for k in range(400)]
    rows += [(1000 + k, "copied first line here\ncopied second line here", f"s{k}") for k in range(40)]
    # The copied text counts for one site, and three other texts have its second line: four sites, not five.
    rows += [(2000 + k, f"other {k}\ncopied second line here", f"t{k}") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in line_spread.without_boilerplate(df).collect()}
    assert all(got[k]["text"] == f"own text {k} of this page" and got[k]["n_removed"] == 2 for k in range(40))
    assert all(got[100 + k]["text"] == f"own line {k}" and got[100 + k]["copied"] for k in range(400))
    assert all(got[i]["text"] == text and not got[i]["copied"] for i, text, _ in rows if i >= 1000)


def test_line_spread_of_odd_rows(odd_docs):
    got = line_spread.without_boilerplate(odd_docs.drop("n_words")).drop("n_lines", "n_removed", "copied")
    assert sorted(map(str, got.collect())) == sorted(map(str, odd_docs.drop("n_words").collect()))


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_of_the_table(spark, sf, small):
    texts = {r["doc_id"]: r["text"] for r in small.collect()}
    got = queries.QUERIES["op6_quality_rules"](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_quality_of_odd_rows(odd_docs, no_docs):
    got = {r["doc_id"]: r for r in quality.judge(odd_docs).collect()}
    for doc_id, row in got.items():
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == plain_counts(
            row["text"]
        ), doc_id
    assert got[2]["base_failed"] and got[5]["base_failed"] and not got[2]["kept"]
    assert quality.judge(no_docs).count() == 0


def plain_mcd(x):
    """The same start and steps, with exact quantiles."""
    spread = np.diag(np.square(quality.SPREAD))
    center = np.median(x, axis=0)
    cov = np.diag(np.square(np.subtract(*np.quantile(x, [0.75, 0.25], axis=0)) / 1.349)) + spread
    for step in range(quality.STEPS):
        d2 = np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(cov), x - center)
        half = x[d2 <= np.quantile(d2, quality.HALF, method="inverted_cdf")]
        center = half.mean(0)
        cov = np.cov(half.T, bias=True) * (quality.CONSISTENCY if step == quality.STEPS - 1 else 1) + spread
    return np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(cov), x - center)


def test_distances_against_numpy(spark):
    rng = np.random.default_rng(5)
    rows, planted = [], set()
    for k in range(600):
        n = int(rng.integers(60, 900))
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(n)]
        if k % 10 == 0:
            words = [w + "###" for w in words]
            planted.add(k)
        rows.append((k, " ".join(words), "en", "s0" if k < 500 else f"tiny{k}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in quality.judge(df).collect()}
    assert {k for k, r in got.items() if not r["kept"]} == planted
    own = [got[k] for k in range(500)]
    x = np.array(
        [
            [math.log(r["n_words"]), math.log(r["word_chars"] / r["n_words"]), math.sqrt(r["n_symbols"] / r["n_words"]),
             r["n_dup_lines"] / r["n_lines"], math.sqrt(r["n_repeat_words"] / r["n_words"])]
            for r in own
        ]
    )
    assert np.allclose([r["distance"] for r in own], plain_mcd(x), rtol=0.15, atol=0.3)


def test_scores_of_the_table(spark, sf, small):
    docs = {r["doc_id"]: WORD.findall(r["text"].translate(AZ)) + ["<end>"] for r in small.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in docs}
    counts = Counter(w for k, own in docs.items() if not held[k] for w in own)
    n, v = sum(counts.values()), len(counts)
    got = {r["doc_id"]: r for r in queries.QUERIES["op7_lm_scoring"](spark, sf).collect()}
    assert len(got) == len(docs)
    for k, own in docs.items():
        row = got[k]
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (held[k], len(own), n)
        assert row["n_known"] == sum(counts[w] > 0 for w in own)
        assert math.isclose(row["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert math.isfinite(row["score"]) and row["score"] < 0
    fresh = [k for k in docs if held[k]]
    assert sum(got[k]["score"] for k in fresh) > sum(got[k]["base_score"] for k in fresh)


def test_probabilities_sum_to_one(spark, small, monkeypatch):
    monkeypatch.setattr(pitman_yor, "LOOKUP", 50)
    model = pitman_yor.fit(small)
    assert np.allclose((10**model.log_class).sum(axis=1), 1, atol=1e-9)
    open_words = model.scored.where((F.col("c") * pitman_yor.CLASSES < model.n_tokens) & (F.col("word") != -1))
    assert math.isclose(open_words.agg(F.sum(F.pow(10.0, "log_p"))).first()[0] + 10**model.log_unknown, 1, rel_tol=1e-6)
    rare = pitman_yor.score(small, model, F.lit(False)).collect()
    monkeypatch.setattr(pitman_yor, "LOOKUP", 1 << 20)
    looked_up = {r["doc_id"]: r for r in pitman_yor.score(small, model, F.lit(False)).collect()}
    for r in rare:
        other = looked_up[r["doc_id"]]
        assert r["n_known"] == other["n_known"] == r["n_tokens"]
        assert math.isclose(r["score"], other["score"], rel_tol=1e-9)


def test_pairs_seen_once_are_counted_but_not_stored(spark, monkeypatch):
    """op7: only pairs seen several times, or once and in texts held out too, are rows; contexts are dealt by word."""
    monkeypatch.setattr(pitman_yor, "AT_LEAST", 3)
    monkeypatch.setattr(pitman_yor, "SPREAD", 8)
    rows = [(k, f"a b{k % 3} a c{k} {'d ' * (k % 4)}") for k in range(20)] + [(20, None), (30, "a c1 new c2 a"), (31, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pairs, fresh = Counter(), set()
    for k, text in rows:
        own = ["<end>", *(text or "").split(), "<end>"]
        (fresh.update if k >= 30 else pairs.update)(zip(own, own[1:]))
    counts = pitman_yor.word_counts(df.where("doc_id < 30"))
    n = sum(r["c"] for r in counts.collect())
    spread = pitman_yor.Spread.of(counts, n)
    assert n == sum(pairs.values()) and spread.pieces.max() > 1
    got = pitman_yor.count_pairs(df, F.col("doc_id") >= 30, spread, np.array([-1]), n).collect()
    kept = sorted(c for pair, c in pairs.items() if c > 1 or pair in fresh)
    assert sorted(r["c"] for r in got if r["kind"] == pitman_yor.PAIR) == kept
    once = [pair for pair, c in pairs.items() if c == 1]
    assert 0 < len(kept) < len(pairs)
    for kind, place in ((pitman_yor.ONCE_BEFORE, 0), (pitman_yor.ONCE_WORD, 1)):
        sums = Counter()
        for r in got:
            sums[r["word"]] += r["c"] if r["kind"] == kind else 0
        assert sorted(x for x in sums.values() if x) == sorted(Counter(pair[place] for pair in once).values())
    assert sum(r["c"] for r in got if r["kind"] == pitman_yor.ONCE_CLASSES) == len(once)


def test_rare_words_are_contexts(spark):
    """Words far below a class of their own predict the word that follows them."""
    rows = [(k, f"key{k % 900} value{k % 900} filler{k % 7} filler{k % 5}") for k in range(2700)]
    rows += [(5000, "key17 value17"), (5001, "key17 value18"), (5002, "unknown value17")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") >= 5000
    model = pitman_yor.fit(df.where(~held))
    got = {r["doc_id"]: r for r in pitman_yor.score(df, model, held).collect()}
    assert len(got) == len(rows) and got[5002]["n_known"] == 2
    assert got[5000]["score"] > got[5001]["score"] + 1.5
    # Every known word after one context, and one unknown word, share all but what the root leaves to the start.
    contexts = model.contexts.where("n = 3").limit(1).select("before")
    every = contexts.crossJoin(model.scored.select("word")).join(model.pairs, ["before", "word"], "left").fillna(0)
    one = contexts.select("before", F.lit(-77).cast("long").alias("word"), F.lit(0).cast("long").alias("c"), F.lit(0).cast("long").alias("t"))
    total = pitman_yor.scored_pairs(saved(every.unionByName(one), "every"), model).agg(F.sum(F.pow(F.lit(10.0), "log_p"))).first()[0]
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_seating_follows_the_restaurant():
    """Mean number of tables of customers who sit down at weight A, against the recursion."""
    n, a, d = 40, 0.7, 0.3
    p = {1: 1.0}
    for j in range(1, n):
        new = Counter()
        for t, q in p.items():
            open_table = a / (a + j - d * t)
            new[t + 1] += q * open_table
            new[t] += q * (1 - open_table)
        p = new
    keys = np.arange(20_000)
    t = pitman_yor.seat(np.full(20_000, n), np.full(20_000, a), d, keys, 1)
    assert abs(t.mean() - sum(k * q for k, q in p.items())) < 0.05
    assert (pitman_yor.seat(keys, np.full(20_000, a), d, keys, 2) <= keys).all()


def test_scores_of_odd_rows(odd_docs, no_docs):
    got = pitman_yor.score_held_out(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3, 6)} == {1}
    assert len({r["score"] for r in got if r["doc_id"] == 1}) == 1
    assert pitman_yor.score_held_out(no_docs).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def digits(m):
        return [int(x) for x in re.findall("[0-9]", m[0])]

    def passes(own):
        own = [2 * x if k % 2 else x for k, x in enumerate(reversed(own))]
        return sum(x - 9 if x > 9 else x for x in own) % 10 == 0

    found = [(*m.span(), 0) for m in EMAIL.finditer(text)]
    found += [(*m.span(), 1) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    found += [(*m.span(), 2) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and passes(digits(m))]
    found += [(*m.span(), 3) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


PARTS = ["a", "b.c", "@", "x.y", ".", "-", "+", "1", "25", "255", "256.", "4111 1111-1111 1111", "é", " ", "\n", "+1 (988) 555-2485", "_", "10.0.0.1"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_patterns(text):
    assert [s[:3] for s in sanitise.base_spans(text)] == plain_spans(text)


def test_personal_data_of_the_table(spark, sf, small):
    texts = {r["doc_id"]: r["text"] for r in small.collect()}
    got = queries.QUERIES["op10_pii_sanitisation"](spark, sf).collect()
    assert len(got) == len(texts) and sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in got) > 0
    for r in got:
        own = plain_spans(texts[r["doc_id"]])
        listed = ",".join(f"{sanitise.KINDS[k]}:{a}:{b}" for a, b, k in own)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in sanitise.KINDS] == [sum(s[2] == k for s in own) for k in range(4)]
        assert set(filter(None, listed.split(","))) <= set(r["spans"].split(","))


def test_revealing_terms(spark):
    rows = [(k, f"Report {k} by Zebulon Quartz of unit {k}, zq@example.com, on day {k}.\nPlain text é {k}") for k in range(6)]
    rows += [(10 + k, f"Report number {k} of unit {k} by somebody on a day.\nAnother {k}") for k in range(40)]
    rows += [(100 + k, "Copied Lantern page, lantern@example.com, every copy the same") for k in range(30)]
    # Words on the other lines are terms as well: these ones also stand in texts without the address.
    rows += [(300 + k, f"Plain text é {k}") for k in range(20)]
    rows += [(200, None), (201, ""), (0, rows[0][1])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, spans string")
    got = {r["doc_id"]: r for r in sanitise.find_spans(df).collect()}
    text = rows[0][1]
    words = {text[s["first"] : s["last"]] for s in got[0]["spans"] if s["kind"] == sanitise.REMOVED}
    assert words == {"Zebulon", "Quartz"}
    assert "Zebulon" not in got[0]["sanitised"] and "<email>" in got[0]["sanitised"] and "Plain text é" in got[0]["sanitised"]
    assert [s["kind"] for s in got[100]["spans"]] == ["email"]
    assert got[200]["spans"] == [] and got[201]["sanitised"] is None and got[10]["spans"] == []
    assert sanitise.find_spans(df.where("false")).count() == 0


def test_copies_do_not_unmake_a_pair(spark):
    """Three independent documents reveal an entity, however many copies one of them has."""
    rows = [(k, f"Zebulon wrote report {k}, zq@example.com") for k in range(3)]
    rows += [(10 + k, rows[0][1]) for k in range(4)] + [(100 + k, f"report number {k} by somebody") for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in sanitise.find_spans(df).collect()}
    assert all("Zebulon" not in got[k]["sanitised"] for k in (0, 1, 2, 10, 13))


def plain_disclosures(texts):
    """Every pair of entity and word of some text with its disclosure, by counting documents one pair at a time."""
    kinds = [{(k, v) for *_, k, v in sanitise.base_spans(t)} for t in texts]
    own = []
    for t in texts:
        for a, b, *_ in reversed(sanitise.base_spans(t)):
            t = t[:a] + "\x00" * (b - a) + t[b:]
        own.append(set(re.findall(r"[A-Za-z0-9\u0080-\U0010FFFF]+", t)))
    n, out = len(texts), {}
    for e in set().union(*kinds):
        n_e = sum(e in k for k in kinds)
        for w in set().union(*(o for o, k in zip(own, kinds, strict=True) if e in k)):
            n_t = sum(w in o for o in own)
            n_et = sum(w in o and e in k for o, k in zip(own, kinds, strict=True))
            out[e, w] = (math.log(n_et * n / (n_e * n_t)) / math.log(n / n_e), n_et)
    return out


def test_disclosures_against_plain_counts(spark):
    rng = random.Random(7)
    names = [f"name{k}" for k in range(8)]
    common = [f"word{k}" for k in range(200)]
    texts = []
    for k in range(300):
        text = rng.choices(common, k=30)
        if k % 5 == 0:
            person = k // 5 % 8
            text.insert(3, f"{names[person]}\n" if rng.random() < 0.9 else "\n")
            text.insert(20, f"p{person}@example.org")
        elif rng.random() < 0.03:
            text.insert(8, rng.choice(names))
        texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = saved(sanitise.detect(docs), "found")
    got = {(r["entity"], r["term"]): r for r in sanitise.disclosures(found, docs).collect()}
    want = {
        (sanitise._long(f"{k}:{v}"), int(sanitise.free_words(w, [])[2][0])): d
        for ((k, v), w), (d, n) in plain_disclosures(texts).items()
        if n >= 3 and d >= sanitise.GENERALISE and n * d * math.log(300 / 8) >= math.log(300)
    }
    assert len(want) > 5 and set(want) == set(got)
    assert all(got[k]["disclosure"] == pytest.approx(want[k]) for k in want)
    assert {r["action"] for r in got.values()} <= {sanitise.REMOVED, sanitise.GENERALISED}


def test_terms_anywhere_in_the_text(spark):
    """A name on another line, far from the address, goes; what near-copies share and common words stay."""
    rng = random.Random(3)
    filler = [f"filler{k}" for k in range(60)]

    def some(n):
        return " ".join(rng.choices(filler, k=n))

    rows = [(k, f"Zorblatt Quimby, head of office\n{some(40)}\nwrite to zq@example.org {some(9)}") for k in range(6)]
    copied = some(60).split()
    for k in range(30):
        own = copied.copy()
        own[k] = f"edit{k}"
        rows.append((100 + k, f"Copied Lantern page {' '.join(own)}\nmail lantern@example.com"))
    edited = some(110).split()
    for k in range(4):
        own = [f"change{k}x{i}" if rng.random() < 0.05 else w for i, w in enumerate(edited)]
        rows.append((150 + k, f"Edited Harbour page {' '.join(own)} harbour@example.com"))
    rows += [(200 + k, f"head of office of {some(30)} write to us") for k in range(150)]
    # An address in a third of all texts: words that stand beside it a few times by chance are no sign of it.
    rows += [(1000 + k, f"{some(20)} rare{k % 40} info@example.com") for k in range(120)]
    got = {r["doc_id"]: r for r in sanitise.find_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    gone = {k: {texts[k][s["first"] : s["last"]] for s in got[k]["spans"]} for k in texts}
    assert all(gone[k] == {"Zorblatt", "Quimby", "zq@example.org"} for k in range(6))
    assert all(gone[100 + k] == {"lantern@example.com"} for k in range(30))
    assert all(gone[150 + k] == {"harbour@example.com"} for k in range(4))
    assert all(gone[1000 + k] == {"info@example.com"} for k in range(120))


def test_free_words_and_sketches():
    text = "é one zq@example.org\ntwo, three"
    first, last, _ = sanitise.free_words(text, sanitise.base_spans(text))
    assert [text[a:b] for a, b in zip(first, last, strict=True)] == ["é", "one", "two", "three"]
    assert sanitise.sketch("a b c d e f") != sanitise.sketch("a b c d e g")
    assert sanitise.sketch("A b, c") == sanitise.sketch("a b c") and len(sanitise.sketch("")) == sanitise.ORDERS


def test_spans_of_odd_rows(odd_docs):
    got = sanitise.find_spans(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert [s["kind"] for r in got if r["doc_id"] == 8 for s in r["spans"]] == ["email"]


def test_overlaps_of_texts_of_one_word_over_and_over(spark):
    """Work grows with the lengths, not with their product; ids of items may be null."""
    docs = spark.createDataFrame([(1, "la " * 40_000), (2, "la " * 12), (3, "b c la " * 9_000)], "doc_id long, text string")
    items = [("i", "la " * 20_000), ("j", "x " * 30 + "la " * 13), (None, "b c la " * 6_000), ("k", "la la")]
    bench = spark.createDataFrame(items, "item_id string, text string")
    start = time.monotonic()
    got = {r["doc_id"]: r for r in decontaminate.overlaps(docs, bench).collect()}
    assert time.monotonic() - start < 60
    ids = {k: {h["item_id"] for h in r["hits"]} for k, r in got.items()}
    assert ids == {1: {"i", "j", "k"}, 2: {"k"}, 3: {None}}
    assert [got[k]["n_hit"] for k in (1, 2, 3)] == [40_000, 12, 27_000]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b"]), max_size=40), st.lists(st.sampled_from([b"a", b"b"]), min_size=3, max_size=40))
def test_shared_windows(own, theirs):
    k = 3
    known = {tuple(theirs[q : q + k]) for q in range(len(theirs) - k + 1)}
    want = {w for p in range(len(own) - k + 1) if tuple(own[p : p + k]) in known for w in range(p, p + k)}
    runs = decontaminate.shared_windows(own, theirs, k)
    assert {w for a, b in runs for w in range(a, b)} == want


def test_links_over_fingerprints_of_rows_without_an_id(spark, monkeypatch):
    prints = spark.createDataFrame([(1, 0), (None, 3), (3, 15), (None, 1 << 40), (5, -1)], "doc_id long, simhash long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *args: prints)
    got = {(r["doc_id"], r["simhash"]): r["component_id"] for r in simhash.near_duplicates(prints).collect()}
    assert got == {(1, 0): 1, (None, 3): 1, (3, 15): 1, (None, 1 << 40): 1, (5, -1): 5}
    far = spark.createDataFrame([(None, 255), (None, 255)], "doc_id long, simhash long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *args: far)
    assert [r["component_id"] for r in simhash.near_duplicates(far).collect()] == [None, None]


def test_terms_of_rows_without_an_id(spark):
    rows = [(k if k % 2 else None, f"row {k} Zorblatt zq@example.org with more {k}") for k in range(8)]
    rows += [(100 + k, f"plain words of text {k} row with more") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [r for r in sanitise.find_spans(df).collect() if r["spans"]]
    assert len(got) == 8 and all(any(s["kind"] == sanitise.REMOVED for s in r["spans"]) for r in got)
