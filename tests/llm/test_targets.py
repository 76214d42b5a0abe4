"""Personal data (op11), resampling to a target (op12) and ranked search (op13)."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_helpers import prose
from tillflow.llm import lexical_search, pii, target_resample
from tillflow.llm.byte_words import byte_words
from tillflow.llm.shared import TO_LOWER

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
EXTRA = ["row_id", "line", "score", "rank", "weight", "item_id", "term", "n", "label", "spans"]


def plain_words(text):
    return WORD.findall((text or "").translate(TO_LOWER))


def test_byte_words_are_the_words_of_the_pattern(rng):
    letters = "aZz09_-éÿあ\U0001F600 \n\t.,@[`{~\x00\x7f\u0080"
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        assert [w.decode() for w in byte_words(text.encode())] == plain_words(text)


# ------------------------------------------------------------ resampling

def brute_resample(rows, target, max_n, least, percent):
    def features(text):
        w = plain_words(text)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 500
                for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(features(text))
    for text in target:
        t.update(features(text))
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 500) / ((s[b] + 1) * (T + 500)))) for b in range(500)]
    scored = []
    for doc_id, text in rows:
        found = features(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((doc_id, len(found), weight, weight + noise, len(plain_words(text)) >= least))
    able = sorted((x for x in scored if x[4]), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = able[:percent * len(able) // 100]
    out = Counter((*x[:4], k + 1) for k, x in enumerate(drawn))
    left = Counter(x[:4] for x in scored)
    left.subtract(Counter(x[:4] for x in drawn))
    out.update({(*x, None): n for x, n in left.items() if n})
    return out


@pytest.mark.parametrize("max_n", [1, 2, 4])
def test_resample_equals_brute_force(spark, documents, odd_rows, rng, max_n):
    shared = [prose(rng, rng.randrange(0, 14)) for _ in range(6)]
    rows = list(odd_rows)
    for doc_id in range(100, 140):  # lines shared between and within texts, short and empty ones
        lines = [rng.choice(shared) if rng.random() < 0.6 else prose(rng, rng.randrange(0, 9)) for _ in range(7)]
        rows.append((doc_id, rng.choice(["\n", "\n\n", "\r\n. \n"]).join(lines), "a"))
    target = [prose(rng, 30), shared[0] + "\n" + shared[1].upper(), None, ""]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = target_resample.resample(documents(rows, EXTRA), aim, max_n=max_n, buckets=500, percent=30)
    want = brute_resample([r[:2] for r in rows], target, max_n, 20, 30)
    assert Counter(map(tuple, got.collect())) == want
    assert sum(n for x, n in want.items() if x[4]) > 5


def test_resample_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], "text string")
    assert target_resample.resample(documents([]), none).collect() == []
    rows = target_resample.resample(documents([(1, "a b", "x"), (2, None, "x")]), none).collect()
    assert sorted((r.doc_id, r.n_features, r.rank) for r in rows) == [(1, 2, None), (2, 0, None)]


def test_lines_are_counted_once_and_hot_lines_join_by_key(spark, documents):
    rows = [(i, "the same line\nthe same line\nown %d" % i, "a") for i in range(50)]
    counted = target_resample.Counted(documents(rows), "once", 1, 100)
    lines = {r.n_words: r.times for r in counted.lines.where("n_words = 3").collect()}
    assert counted.lines.count() == 51 and lines == {3: 100}


# ------------------------------------------------------------ ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(rows, items, k):
    terms = [Counter(TERM.findall((t or "").translate(TO_LOWER))) for _, t in rows]
    N, L = sum(bool(c) for c in terms), sum(c.total() for c in terms)
    df = Counter(t for c in terms for t in c)
    w = lambda t: math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
    out = Counter()
    for item_id, text in items:
        asked = Counter(TERM.findall((text or "").translate(TO_LOWER)))
        scored = []
        for (doc_id, _), c in zip(rows, terms):
            m = 100 - 25 + (25 * c.total() * N) // max(L, 1)
            score = sum(q * w(t) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out.update((item_id, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k]))
    return out


@pytest.mark.parametrize("per_pass", [5, 100_000])
def test_search_equals_brute_force(spark, documents, odd_rows, rng, per_pass):
    texts = [prose(rng, rng.randrange(1, 60)) for _ in range(40)]
    rows = list(odd_rows) + [(i, rng.choice(texts) if i % 3 else texts[i % 40] + " Z9 z9", "a") for i in range(100, 400)]
    items = [(1, texts[0]), (1, texts[1].upper()), (None, "one two z9 z9"), (3, None), (4, "..."), (5, texts[2] + texts[3])]
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = lexical_search.search(documents(rows, EXTRA).repartition(5), frame, k=7, terms_per_pass=per_pass)
    assert Counter(map(tuple, got.collect())) == brute_search([r[:2] for r in rows], items, 7)


def test_search_of_empty_tables(spark, documents, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical_search.search(documents(odd_rows), none).collect() == []
    assert lexical_search.search(documents([]), some).collect() == []


def _random_block(rows, terms, rng):
    lists = [np.sort(rng.choice(terms, rng.integers(1, 12), replace=False)) for _ in range(rows)]
    values = [rng.integers(1, 1_000_000, len(x)) for x in lists]
    start = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
    return lexical_search.Block(np.arange(rows).astype(object), start, np.concatenate(lists), np.concatenate(values))


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    block = _random_block(700, 60, rng)
    near = block.take(np.repeat(np.arange(5), 140))  # five groups of copies: tight balls
    items = lexical_search.Items([0, 1], [{3: 9_000, 7: 20}, {int(t): 500 for t in block.terms[:4]}], 60)
    for rows in (block, near):
        tree = lexical_search.BallTree(rows, items)
        below = [[] for _ in tree.leaves]
        for node in range(len(tree.leaves) - 1, -1, -1):
            leaf = tree.leaves[node]
            below[node] = [leaf] if leaf is not None else [x for c in tree.children[node] for x in below[c]]
            for item in range(2):
                dense = np.zeros(60, np.int64)
                items.dense(item, dense)
                assert max(int(x.times(dense).max()) for x in below[node]) <= tree.bounds[node][item]
        best = lexical_search.Best(2, 3)
        scored = tree.search(best)
        for item in range(2):
            dense = np.zeros(60, np.int64)
            items.dense(item, dense)
            want = sorted(zip(-rows.times(dense), rows.ids))[:3]
            assert sorted((-s, -d) for s, d in best.heaps[item]) == [x for x in want if x[0]]
        if rows is near:
            assert scored < 2 * sum(x is not None for x in tree.leaves)


def test_long_texts_are_counted_in_pieces(rng, monkeypatch):
    text = prose(rng, 5_000).encode() + b"x" * 300
    whole = lexical_search.count_terms(text)
    monkeypatch.setattr(lexical_search, "PIECE_BYTES", 64)
    assert lexical_search.count_terms(text) == whole


# ------------------------------------------------------------ personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            good = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 16 <= len(digits) <= 19 and sum(
                        d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1])) % 10 == 0,
                    "phone": lambda: 8 <= len(digits) <= 15}[kind]()
            if good:
                out.append((kind, *m.span()))
    return out


def test_base_spans_equal_the_patterns(rng):
    parts = ["a.b@c.de", "@", "x@y", "a@b@c.d", "1.2.3.4", "256.1.1.1", "01.002.3.255", "1.2.3.4.5.6.7.8", "4539 1488 0343 6467",
             "4539148803436467", "4539-1488--0343", "+1 (718) 555-1498", "+1..", "+12", " ", "é", "\U0001F600", "..", "-", "7", "\n", "%+"]
    for _ in range(3_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_long_runs_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1.1." * 50_000, "+1" * 50_000, "a@" * 50_000, "+1" + " " * 200_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def sampled(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return [r.text for r in docs.where("text rlike '[0-9@]'").select("text").orderBy("doc_id").collect()]


@pytest.fixture(scope="module")
def tagger(sampled):
    """Learned from every second of the texts."""
    found = [pair for i, text in enumerate(sampled[::2]) for pair in pii.windows_from(text, i, most=24)]
    made = pii.Tagger()
    losses = made.fit(pii.padded([x for x, _ in found], np.int16), pii.padded([y for _, y in found], np.int8), epochs=12)
    assert losses[-1] < losses[0] / 4
    return made


def test_the_tagger_finds_most_held_out_spans(sampled, tagger):
    right = told = known = 0
    for text, tagged in zip(sampled[1::2], pii.tag(sampled[1::2], tagger)):
        base = set(pii.base_spans(text))
        right, told, known = right + len(base & set(tagged)), told + len(tagged), known + len(base)
    assert known > 20 and right >= 0.75 * known and right >= 0.75 * told


def test_slopes_equal_differences():
    texts = ["call +1 (718) 555-1498 or a.b@mail.example.com now", "short 1.2.3.4"]
    windows = pii.padded([pii.classes(t) for t in texts], np.int16)
    labels = pii.padded([pii.labels_of(pii.base_spans(t), 0, len(t)) for t in texts], np.int8)
    tagger = pii.Tagger(3)
    tagger.p = {k: v.astype(np.float64) for k, v in tagger.p.items()}
    _, slopes = tagger.learn(windows, labels)
    for name, slope in slopes.items():
        place = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept = tagger.p[name][place]
        ends = []
        for step in (1e-3, -1e-3):
            tagger.p[name][place] = kept + step
            ends.append(tagger.learn(windows, labels)[0])
        tagger.p[name][place] = kept
        assert (ends[0] - ends[1]) / 2e-3 == pytest.approx(slope[place], rel=1e-2), name


def test_windows_passed_over_change_nothing(sampled, tagger, monkeypatch):
    texts = sampled[:40] + ["x" * 60 + "a" * 70 + "@" + "b" * 80 + ".example.com " + "y " * 90, "7", "", "x" * pii.WINDOW + "1"]
    want = [pii.added_spans(t, g, []) for t, g in zip(texts, pii.tag(texts, tagger))]
    assert sum(map(len, want)) > 20
    monkeypatch.setattr(pii, "first_windows", lambda text: set(range(pii.grid(len(text)))))
    assert want == [pii.added_spans(t, g, []) for t, g in zip(texts, pii.tag(texts, tagger))]


def test_every_place_has_one_window():
    for length in (*range(0, 4 * pii.WINDOW), 1_000):
        spans = [pii.owned(k, length) for k in range(pii.grid(length))]
        assert spans[0][0] == 0 and spans[-1][1] == length
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        for at in range(length):
            (k,) = pii.first_windows("x" * at + "1" + "x" * (length - at - 1))
            assert spans[k][0] <= at < spans[k][1] and k * pii.STEP <= at < k * pii.STEP + pii.WINDOW


def test_seams_join_runs():
    step = pii.STEP
    first, second = np.zeros(pii.WINDOW, np.int8), np.zeros(pii.WINDOW, np.int8)
    seam = step + step // 2
    first[seam - 5:seam + 9] = 2
    first[seam - 5] = 1
    second[step // 2 - 7:step // 2 + 4] = 2
    second[step // 2] = 1  # begins anew just at the seam: still one span
    assert pii.reconciled(400, {0: first, 1: second}) == [("email", seam - 5, seam + 4)]
    assert pii.reconciled(400, {0: first}) == [("email", seam - 5, seam)]


def test_personal_data_rows(spark, documents, odd_rows, sampled):
    rows = odd_rows + [(50 + i, t, "a") for i, t in enumerate(sampled[:30])] + [(50, sampled[0], "b")]
    got = pii.find_personal_data(documents(rows, EXTRA), sample=10, epochs=1).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    texts = {}
    for doc_id, text, *_ in rows:
        texts.setdefault(doc_id, []).append(text or "")
    for r in got:
        fits = [t for t in texts[r.doc_id] if hashlib.sha256(pii.joined(brute_spans(t)).encode()).hexdigest() == r.base_sha256]
        assert fits
        counts = Counter(k for k, *_ in brute_spans(fits[0]))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [counts[k] for k in pii.KINDS]
        listed = r.spans.split(",") if r.spans else []
        assert set(f"{k}:{a}:{b}" for k, a, b in brute_spans(fits[0])) <= set(listed)
    assert pii.find_personal_data(documents([])).collect() == []
    assert [r.spans for r in pii.find_personal_data(documents([(1, "no digits", "a")])).collect()] == [""]
