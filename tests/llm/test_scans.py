import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from llm_helpers import prose, words
from tillflow.llm import decontaminate, license_scan, mixing, toxicity
from tillflow.llm.toxicity import Features, Ftrl, sigmoid

FOLDER = "/root/testdata/sf0.001"
ITEMS = "item_id long, text string"


# ------------------------------------------------------------ decontamination

def leaks(frame, items, **kw):
    return {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(frame, items, **kw).collect()}


@pytest.mark.parametrize("block", [7, 2_000_000])
def test_leaks_with_substitutions(spark, documents, rng, block):
    texts = {i: prose(rng, rng.randrange(15, 50)) for i in range(12)}
    rows, want = [], set()
    for doc_id in range(60):
        body = prose(rng, rng.randrange(5, 200)).split()
        if doc_id % 3 == 0:
            item = doc_id % 12
            leak = texts[item].split()
            for k in range(doc_id % 5, len(leak), 8):  # every eighth word differs
                if doc_id % 2:
                    leak[k] = words(rng, 1)[0]
            body[3:3] = [w.upper() for w in leak]
            want.add((doc_id, item))
        rows.append((doc_id, "  ".join(body), "a"))
    items = spark.createDataFrame(list(texts.items()), ITEMS)
    assert leaks(documents(rows, extra=["item_id", "words", "seed"]), items, block=block) == want


def test_leak_rules(spark, documents, odd_rows):
    item = "the quick brown fox jumps over the lazy dog and runs far away from here now"
    nameless = "an item without any id is named by a result row like all others are"
    items = spark.createDataFrame([(1, item), (2, item.upper()), (3, None), (4, ""), (5, "one two"), (None, nameless),
                                   (1, "brown fox jumps"), (6, item[:40]), (6, nameless), (None, item)], ITEMS)
    rows = odd_rows + [(40, "x " + item, "a"), (41, item[10:], "a"), (41, item[10:], "a"), (None, item, "a"),
                       (42, "the quick fox jumps", "a"), (43, " ".join(item.split()[::-1]), "a"),
                       (44, "so " + nameless, "a"), (45, "a Brown FOX jumps.", "a"), (46, "a brown fox jumps", "a")]
    frame = documents(rows)
    found = {(r.doc_id, r.item_id, r.item_words) for r in decontaminate.find_leaks(frame, items).collect()}
    whole = {(i, 16) for i in (1, 2, None)} | {(1, 3), (6, 8)}
    assert found == ({(d, *x) for d in (40, None) for x in whole} | {(41, i, 16) for i in (1, 2, None)}
                     | {(41, 1, 3), (41, 6, 8), (44, None, 15), (44, 6, 15), (46, 1, 3), (7, 5, 2)})
    kept = decontaminate.without_leaks(frame, items)
    assert kept.columns == frame.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in odd_rows) + Counter([42, 43, 45])
    assert leaks(documents([]), items) == set() == leaks(frame, items.limit(0))


def test_a_short_item_stands_as_it_is(spark, documents):
    items = spark.createDataFrame([(1, "a b c"), (2, "q"), (3, "one two three four five")], ITEMS)
    rows = [(1, "a b c", "x"), (2, "z a b c z", "x"), (3, "a b x c", "x"), (4, "b c", "x"), (5, "z q", "x"),
            (6, "one two three four five", "x"), (7, "one two x four five", "x")]
    assert leaks(documents(rows), items) == {(1, 1), (2, 1), (5, 2), (6, 3)}
    assert leaks(documents(rows), items, least_words=4) == {(6, 3)}


def test_leaks_of_the_table_hold_whole_passages(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda t: " " + " ".join(t.lower().split()) + " "
    passages = [(r.item_id, plain(r.text)) for r in items.collect()]
    want = {(r.doc_id, i) for r in docs.collect() for i, p in passages if p in plain(r.text)}
    assert want and leaks(docs, items) == want


def test_leak_plan_is_native(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.find_leaks(docs, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)


# ------------------------------------------------------------ licenses

def brute_scan(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES:
        want = phrase.split()
        hits = [i for i in range(len(found)) if found[i:i + len(want)] == want]
        places += hits
        labels |= {label} if hits else set()
    return (len(found), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


def test_license_base_counts(documents, odd_rows, rng):
    parts = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "é", "x", "CC-BY", "GNU\nGeneral"]
    rows = [(100 + i, " ".join(rng.choice(parts) for _ in range(rng.randrange(40))), "a") for i in range(80)]
    rows += odd_rows + [(300, "-MIT license-apache_license.", "a"), (301, "mit license", "a"), (301, "mit license", "a")]
    got = license_scan.scan(documents(rows, extra=["n_words", "template", "gram"])).collect()
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in got) == Counter(
        (i, *brute_scan(t)) for i, t, _ in rows)
    for r in got:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        assert r.score == 1.0 if r.n_base else r.score < 1 or r.labels


def test_license_notices(documents, rng):
    notice = license_scan.NOTICES[0][0].split()
    changed = notice[:8] + ["added"] + notice[8:]
    rows = [(1, prose(rng, 30) + " " + " ".join(changed) + ".", "a"), (2, " ".join(notice[:6]), "a"),
            (3, "Licensed under CC BY-NC 4.0.", "a"), (4, " ".join(notice[::-1]), "a")]
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(documents(rows)).collect()}
    assert got[1][0] == "mit" and got[1][1] >= license_scan.COVER
    assert got[2] == ("", 0.0) == got[4] and got[3] == ("cc-by,cc-by-nc", 1.0)
    assert license_scan.scan(documents([])).collect() == []


def brute_notices(text, notices):
    """Best share of a notice's k-grams on one diagonal, where no word is added or left out."""
    found, best = "".join(c.lower() if c.isascii() and c.isalnum() else c if ord(c) > 127 else " "
                          for c in text or "").split(), {}
    for notice, label in notices:
        want = (notice or "").lower().split()
        k = min(3, len(want))
        if label is None or k < 2:
            continue
        for shift in range(-len(want), len(found)):
            hits = sum(shift + p >= 0 and found[shift + p:shift + p + k] == want[p:p + k]
                       for p in range(len(want) - k + 1))
            share = hits / (len(want) - k + 1)
            if share >= license_scan.COVER:
                best[label] = max(best.get(label, 0), share)
    return ",".join(sorted(best)), max(best.values(), default=0.0)


@pytest.mark.parametrize("most", [license_scan.MOST, 0])
def test_notices_of_a_table(spark, documents, odd_rows, rng, monkeypatch, most):
    monkeypatch.setattr(license_scan, "MOST", most)
    table = [(" ".join(words(rng, n)), f"own-{n % 4}") for n in (2, 3, 9, 14, 25, 40)]
    table += [table[2], (table[3][0].upper(), "shouted"), (None, "none"), ("", "none"), ("single", "none"),
              (table[4][0], None)]
    rows = [(200 + i, prose(rng, 12) + " " + " ".join((t or "").split()[:99 if i % 2 else -3]) + " " + prose(rng, 9),
             "a") for i, (t, _) in enumerate(table)]
    rows += odd_rows + [(300, "mit license " + table[3][0], "a"), (301, license_scan.NOTICES[3][0], "a")]
    frame = spark.createDataFrame([(t, label, 1) for t, label in table], "text string, label string, gram int")
    got = {(r.doc_id, r.labels, round(r.score, 9))
           for r in license_scan.scan(documents(rows, extra=["label"]), frame).collect() if r.doc_id != 300}
    assert got == {(i, labels, round(score, 9)) for i, t, _ in rows if i != 300
                   for labels, score in [brute_notices(t, [(x and x.lower(), y) for x, y in table])]}
    assert {"own-1", "own-2"} <= {label for _, labels, _ in got for label in labels.split(",")}
    mixed = license_scan.scan(documents(rows[-2:-1]), frame).first()
    assert (mixed.base_labels, mixed.labels, mixed.score) == ("mit", "mit,own-2,shouted", 1.0)
    empty = license_scan.scan(documents(rows[-1:]), frame.where("false")).first()
    assert (empty.labels, empty.score) == ("", 0.0)


# ------------------------------------------------------------ mixing

def water_fill(sizes, share=1.5, most=2.0, weights=(3.0, 1.0, 2.0)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    total, open_ = share * sum(sizes.values()), {s: weights[i % 3] for i, s in enumerate(order)}
    target = {}
    while open_:
        level = (total - sum(target.values())) / sum(open_.values())
        full = [s for s in open_ if level * open_[s] >= most * sizes[s]]
        if not full:
            return target | {s: level * w for s, w in open_.items()}
        for s in full:
            target[s] = most * sizes[s]
            open_.pop(s)
    return target


def test_mixing_targets_and_copies(documents, odd_rows, rng):
    rows = [(i, prose(rng, int(rng.paretovariate(1.1) * 8) % 900), rng.choice("aaaaabbcd")) for i in range(1_500)]
    rows += odd_rows + [(5_000 + i, "only  one", None) for i in range(40)]
    got = mixing.mix(documents(rows, extra=["size", "_rate"]), keep=["doc_id", "source"], block_rows=50).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").encode().split())
    target = water_fill(sizes)
    assert len(got) == len(rows)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.copies <= 2
        taken[r.source] += r.copies * r.size
        largest[r.source] = max(largest[r.source], r.size)
    for source, want in target.items():
        assert abs(taken[source] - want) <= 2 * largest[source] + 0.02 * want
    again = mixing.mix(documents(rows[::-1]), keep=["doc_id", "source"], block_rows=50).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_mixed_rows_keep_columns(documents, odd_rows):
    frame = documents(odd_rows, extra=["size", "copies", "target"])
    got = mixing.mixed_rows(frame)
    assert got.columns == frame.columns
    assert all(r.size == "x" for r in got.collect())
    assert mixing.mixed_rows(documents([])).collect() == []
    blank = mixing.mix(documents([(1, "", "a"), (2, None, None)])).collect()
    assert [(r.target, r.copies) for r in blank] == [(0.0, 0)] * 2


def test_mixing_plan_is_native(documents):
    plan = mixing.mixed_rows(documents([(1, "a b", "a")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Cartesian|NestedLoop", plan)
    assert not re.search(r"Filter [^\n]*split\(", plan)  # a filter would split every text again


def test_mixing_tells_equal_ids_and_sizes_apart_by_text(documents):
    rows = [(1, f"{a} {b}", "a") for a in "pqrstuvw" for b in "xyz"]
    def taken(order):
        return sorted((r.text, r.copies) for r in mixing.mix(documents(order), share=0.7).collect())

    assert taken(rows) == taken(rows[::-1])


# ------------------------------------------------------------ toxicity

def test_ftrl_equals_its_formula(rng):
    model, features = Ftrl(0.5, 1.0, 0.3, 0.2), Features()
    z, n = defaultdict(float), defaultdict(float)
    for step in range(60):
        places = np.unique(features(" ".join(words(rng, 12, 1))))
        label = step % 2
        w = {}
        for i in [*places.tolist(), 1 << toxicity.BITS]:
            l1 = 0.0 if i == 1 << toxicity.BITS else 0.3
            w[i] = 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((1.0 + n[i] ** 0.5) / 0.5 + 0.2)
        g = sigmoid(sum(w.values())) - label
        for i in w:
            z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.5 * w[i]
            n[i] += g * g
        model.learn(places, label)
    assert all(abs(model.z[i] - v) < 1e-9 for i, v in z.items())


def test_features_are_words_pairs_and_skips():
    make = Features()
    assert len(make("")) == 0 and len(make("one")) == 1
    assert len(make("one two three")) == 3 + 2 + 1
    assert make("One, TWO").tolist() == make("one two").tolist() != make("two one").tolist()


def test_toxicity_is_learned_and_held_out(spark, documents, rng):
    bad = words(rng, 4, 5)
    rows, labels = [], []
    for i in range(1_200):
        text = prose(rng, rng.randrange(5, 80)).split()
        toxic = i % 5 == 0
        if toxic:
            text[0:0] = [rng.choice(bad)]
        rows.append((i, " ".join(text), "a"))
        labels.append((i, toxic * 1))
    rows += [(5_000, None, "a"), (5_001, "", "a"), (None, " ".join(bad), "a")]
    labels += [(0, None), (None, 1), (9_999, 1)]
    frame = documents(rows, extra=["_score", "label", "rank"])
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.classify(frame, known).collect()}
    assert len(got) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    tested = [r for i, r in got.items() if i is not None and i < 1_200 and r.held_out]
    right = sum(r.predicted == (r.doc_id % 5 == 0) for r in tested)
    assert len(tested) > 150 and right / len(tested) > 0.97
    assert got[5_000].score == got[5_001].score and got[None].predicted == 1 and not got[None].held_out
    kept = toxicity.without_toxic(frame, known)
    assert kept.columns == frame.columns and None not in {r.doc_id for r in kept.collect()}


def test_toxicity_without_labels_or_rows(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.classify(documents([(1, "a b", "a")]), none).collect()
    assert [(r.doc_id, r.score) for r in got] == [(1, 0.5)]
    assert toxicity.classify(documents([]), none).collect() == []


# ------------------------------------------------------------ pipeline

def test_pipeline_equals_its_stages_by_hand(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    scored = toxicity.classify(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
    rows = {r.doc_id: r for r in docs.collect()}
    left = [i for i in sorted(rows) if {r.doc_id: r.predicted for r in scored}[i] == 0]
    sets = {i: _shingles(rows[i].text) for i in left}
    group = {i: i for i in left}
    for a in left:
        for b in left:
            both = len(sets[a] & sets[b])
            if b < a and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {k: new if v == old else v for k, v in group.items()}
    left = [i for i in left if group[i] == i]
    plain = lambda t: " " + " ".join(t.lower().split()) + " "
    passages = [plain(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = [i for i in left if not any(p in plain(rows[i].text) for p in passages)]
    sizes = defaultdict(int)
    for i in left:
        sizes[rows[i].source] += len(rows[i].text.encode().split())
    target = water_fill(sizes)
    got = Counter(r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert set(got) <= set(left)
    for i in left:
        rate = target[rows[i].source] / sizes[rows[i].source]
        assert got[i] in (int(rate), -int(-rate // 1))


def _shingles(text):
    w = text.encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
