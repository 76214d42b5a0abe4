import hashlib
from collections import defaultdict

import pytest

from llm_helpers import prose, words
from tillflow.llm import line_frequency, ngram_join, paragraph_dedup, trie_dedup
from tillflow.llm.components import components
from tillflow.llm.trie_dedup import Patricia


def lowered(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


# ------------------------------------------------------------ tries

def test_trie_keeps_counts_and_ids(rng):
    trie, want, spilled = Patricia(), defaultdict(list), []
    for i in range(3_000):
        text = "".join(rng.choice("ab") for _ in range(rng.randrange(9))).encode()
        want[text].append(i)
        trie.insert(text, 1, 1, i, i)
        if i % 700 == 699:
            spilled += trie.spill()
    rows = defaultdict(lambda: [0, 10**9, -1])
    for text, n, _, low, high in spilled + trie.drain():
        own = rows[text]
        rows[text] = [own[0] + n, min(own[1], low), max(own[2], high)]
    assert dict(rows) == {t: [len(v), v[0], v[-1]] for t, v in want.items()}
    assert trie.held == 0


@pytest.mark.parametrize("memory", [1, 1 << 20])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_duplicates(documents, odd_rows, memory, keep):
    rows = odd_rows + [(20, "Same TEXT", "a"), (21, "same text", "b"), (22, "sÉ", "a"), (23, "sé", "a")]
    got = trie_dedup.exact_duplicates(documents(rows, extra=["hash", "length"]), keep, memory).collect()
    groups = defaultdict(list)
    for doc_id, text, _ in rows:
        groups[lowered(text)].append(doc_id)
    want = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, best, len(ids), best is None or i == best, sha) for i in ids]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_exact_duplicates_of_no_rows(documents):
    assert trie_dedup.exact_duplicates(documents([])).collect() == []


# ------------------------------------------------------------ components

def test_components_of_chains_and_stars(spark, rng):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (300, 200)]
    rng.shuffle(edges)
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    want = {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 140)} | {300: 200}
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


# ------------------------------------------------------------ n-gram join

def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets, parent = [shingles(t) for _, t, *_ in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    members = defaultdict(list)
    for i, r in enumerate(rows):
        members[find(i)].append(r[0])
    out = []
    for i, r in enumerate(rows):
        ids = [x for x in members[find(i)] if x is not None]
        out.append((r[0], len(sets[i]), (min(ids) if ids else None) if sets[i] else r[0]))
    return sorted(out, key=str)


def mutated(rng, base, changes):
    out = base.split()
    for _ in range(changes):
        out[rng.randrange(len(out))] = words(rng, 1)[0]
    return " ".join(out)


def near_rows(rng):
    rows, shared = [], prose(rng, 80)
    for group in range(6):
        base = prose(rng, rng.randrange(60, 200))
        for _ in range(rng.randrange(2, 9)):
            rows.append((len(rows), mutated(rng, base, rng.randrange(0, 7)), "a"))
    for n in (5, 12, 20, 28, 40):  # a passage that many documents share
        rows += [(len(rows) + k, shared + " " + prose(rng, n), "a") for k in range(4)]
        rows = [(i, r[1], r[2]) for i, r in enumerate(rows)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("rare", [1, 3, 32])
def test_similar_components_lose_no_link(documents, rng, rare):
    rows = near_rows(rng)
    got = ngram_join.similar_components(documents(rows), rare)
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows)


def test_similar_components_of_odd_rows(documents, odd_rows):
    rows = odd_rows + [(30, "a b c", "a"), (31, "A  b\nC", "a"), (32, "a b c d", "a"), (33, "a b", "a")]
    got = ngram_join.similar_components(documents(rows, extra=["sig", "gram", "node", "n"]))
    assert sorted(map(tuple, got.collect()), key=str) == brute_components(rows)
    assert ngram_join.similar_components(documents([])).collect() == []


def test_one_of_each(documents, odd_rows):
    frame = documents(odd_rows, extra=["root"])
    got = ngram_join.one_of_each(frame)
    assert got.columns == frame.columns
    kept = sorted((r.doc_id is None, r.doc_id, r.text or "") for r in got.collect() if r.doc_id is not None)
    assert [k[1] for k in kept] == [1, 2, 3, 4, 5, 7]
    assert sum(r.doc_id is None for r in got.collect()) == 1  # the null text; "one" has an id elsewhere


# ------------------------------------------------------------ passages

def test_repeated_passages(documents, rng):
    passages = [prose(rng, rng.randrange(52, 90)) + "." for _ in range(5)]
    rows = [(i, prose(rng, 150) + " " + passages[i % 5] + " " + prose(rng, 120), "a") for i in range(30)]
    rows += [(i, prose(rng, 200), "a") for i in range(30, 60)]
    got = paragraph_dedup.repeated_passages(documents(rows, extra=["node", "words"])).collect()
    assert {r.doc_id for r in got} == set(range(30))
    texts = {r[0]: r[1].split() for r in rows}
    by_text = defaultdict(list)
    for r in got:
        by_text[" ".join(texts[r.doc_id][r.first_word:r.first_word + r.n_words])].append(r)
    for group in by_text.values():
        assert len({r.component for r in group}) == 1 and len({r.doc_id for r in group if r.kept}) <= 1
    assert all(r.kept == (r.doc_id == r.component) for r in got)


def test_near_passages_are_verified(documents, rng):
    base = " ".join(words(rng, 60)) + "."
    near = base.split()
    near[30] = "other"
    far = base.split()
    far[10], far[30], far[45], far[52], far[20] = "v w x y z".split()
    rows = [(1, base, "a"), (2, " ".join(near), "a"), (3, " ".join(far), "a"), (4, None, "a"), (5, "", "a")]
    got = paragraph_dedup.repeated_passages(documents(rows)).collect()
    assert {r.doc_id for r in got} <= {1, 2, 3} and {1, 2} <= {r.doc_id for r in got}


def pasted(rng, passage, stops):
    """A document that holds ``passage`` at a random word."""
    own = prose(rng, 200).split() if stops else words(rng, 200)
    cut = rng.randrange(30, 170)
    return own[:cut] + passage + own[cut:]


@pytest.mark.parametrize("stops", [True, False])
def test_no_repeated_run_of_50_words_is_lost(documents, rng, stops):
    texts = []
    for n in [50] * 25 + [51, 55, 60, 75, 100]:
        passage = prose(rng, 300).split()[:n] if stops else words(rng, n)
        texts += [pasted(rng, passage, stops), pasted(rng, passage, stops)]
    got = paragraph_dedup.repeated_passages(
        documents([(i, " ".join(t), "a") for i, t in enumerate(texts)])).collect()
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append((r.first_word, r.first_word + r.n_words))
    places = defaultdict(set)  # brute force: all runs of 50 words
    for i, text in enumerate(texts):
        for k in range(len(text) - 49):
            places[tuple(text[k:k + 50])].add((i, k))
    repeated = [p for p in places.values() if len({i for i, _ in p}) > 1]
    assert len(repeated) >= 30
    for spots in repeated:
        for i, k in spots:
            assert any(k <= a and b <= k + 50 for a, b in found[i]), (i, k)


def test_runs_do_not_depend_on_their_surroundings(rng):
    import pyarrow as pa

    passage = words(rng, 120)
    chosen = []
    for before, after in ((0, 0), (40, 40), (7, 90)):
        text = words(rng, before) + passage + words(rng, after)
        units = paragraph_dedup.Units(pa.array([" ".join(text)]))
        starts, until = units.runs()
        nodes = units.nodes(starts, until)
        inner = {(int(s) - before, int(n)) for s, u, n in zip(starts, until, nodes)
                 if u - s == paragraph_dedup.LENGTH and before <= s and u <= before + 120}
        chosen.append({x for x in inner if 24 <= x[0] <= 120 - 53})
    assert chosen[0] and chosen[0] == chosen[1] == chosen[2]


def test_near_copies_that_share_a_frequent_sentence(documents, rng):
    pool = list(dict.fromkeys(words(rng, 2_000, 4)))
    shared, own, rows = pool[:20], iter(pool[20:]), []
    for k in range(80):
        mine = shared + [next(own) for _ in range(5)]
        rows += [(2 * k, " ".join(mine + ["xa."]), "a"), (2 * k + 1, " ".join(mine + ["xo."]), "a")]
    got = paragraph_dedup.repeated_passages(documents(rows)).collect()
    whole = {r.doc_id: r.component for r in got if r.first_word == 0 and r.n_words == 26}
    assert whole == {i: i - i % 2 for i in range(160)}


def test_one_occurrence_stays_of_a_passage_repeated_within_a_document(documents, rng):
    passage, twice = words(rng, 60), words(rng, 60)
    own = words(rng, 120)
    rows = [(1, passage + own[:30] + passage + own[30:60]), (2, own[60:90] + passage),
            (3, twice + own[90:] + twice), (4, words(rng, 200))]
    got = paragraph_dedup.repeated_passages(
        documents([(i, " ".join(t), "a") for i, t in rows])).collect()
    texts, kept = dict(rows), defaultdict(list)
    for r in got:
        kept[tuple(texts[r.doc_id][r.first_word:r.first_word + r.n_words])].append(r.kept)
    assert all(sum(k) <= 1 for k in kept.values())
    assert {r.kept for r in got if r.doc_id == 1} == {r.kept for r in got if r.doc_id == 3} == {True, False}
    assert {r.doc_id for r in got} == {1, 2, 3}


def brute_passages(rows, short=False):
    """All columns of ``repeated_passages`` by loops: every paragraph compared with every other."""
    import pyarrow as pa

    from tillflow.llm.word_hashes import Words

    cut, least = paragraph_dedup.CUT, paragraph_dedup.LEAST
    units, runs = [], []  # (doc_id, place, words), in document order
    for doc_id, text in rows:
        place = 0
        if len(text.split()) >= 5:
            grams = [int(g) for g in Words(pa.array([text])).grams(5)]
        for line in text.split("\n"):
            own = line.split()
            if not own:
                continue
            keys = [(w[-1] not in ".!?", grams[place + i - 4] >> 1) if place + i >= 4 else (True, 0)
                    for i, w in enumerate(own)]
            begin = 0
            for i in range(cut, len(own) - cut):
                if keys[i] < min(keys[i - cut:i]) and keys[i] <= min(keys[i + 1:i + cut + 1]):
                    units.append((doc_id, place + begin, own[begin:i + 1]))
                    begin = i + 1
            units.append((doc_id, place + begin, own[begin:]))
            place += len(own)
        every, size = text.split(), paragraph_dedup.WINDOW
        if len(every) >= 5:
            starts = {k for i in range(len(grams) - size + 1) for k in range(i, i + size)
                      if grams[k] == min(grams[i:i + size])}
            runs += [(doc_id, k, every[k:k + paragraph_dedup.LENGTH]) for k in sorted(starts)
                     if k + paragraph_dedup.LENGTH <= len(every)]
    units = [u for u in units if short or len(u[2]) >= least]
    sets = [{tuple(u[2][i:i + 5]) for i in range(len(u[2]) - 4)} if len(u[2]) >= least else None for u in units]
    every = units + runs
    parent = list(range(len(every)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_words = {}
    for i, u in enumerate(every):
        parent[root(i)] = root(by_words.setdefault(tuple(u[2]), i))
    for i in range(len(units)):
        for j in range(i):
            if sets[i] and sets[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                    parent[root(i)] = root(j)
    groups = defaultdict(set)
    for i, (doc_id, place, own) in enumerate(every):
        groups[root(i)].add((doc_id, place, len(own)))
    out = set()
    for spots in groups.values():
        doc_id, place, size = min(spots)
        last = max(s[:2] for s in spots)
        if last[0] != doc_id or last[1] >= place + size:
            out |= {(d, p, n, doc_id, d == doc_id and p < place + size) for d, p, n in spots}
    return out


@pytest.mark.parametrize("short", [False, True])
def test_whole_output_of_passages_equals_brute_force(documents, rng, short):
    pool = [" ".join(words(rng, 60)) + "." for _ in range(8)]
    long_ = [prose(rng, 260) for _ in range(3)]
    small = ["all rights reserved", "page one of two", "home"]
    rows = []
    for i in range(36):
        line = pool[i % 8].split()
        if i % 3 == 0:  # far above the threshold, where bands find every pair
            line[i % 2] = f"edit{i}"
        if i % 5 == 4:  # below it
            line[15] = line[30] = line[45] = f"far{i}"
        parts = [prose(rng, rng.randrange(10, 150)), " ".join(line), small[i % 3]]
        if i % 4 == 0:
            changed = long_[i % 3].split()
            changed[0] = changed[-1] = f"other{i}"
            parts.append(" ".join(changed))
        if i % 6 == 1:
            parts += [" ".join(line), prose(rng, 20) + " " + pool[(i + 3) % 8] + " " + prose(rng, 25)]
        rows.append((i + 1, "\n".join(parts)))
    rows.append((40, "one " * 300))
    got = paragraph_dedup.repeated_passages(
        documents([(i, t, "a") for i, t in rows]), short=short).collect()
    want = brute_passages(rows, short)
    assert len(got) == len(want) > 100
    assert set(map(tuple, got)) == want


def test_passages_of_odd_rows(documents, odd_rows):
    got = paragraph_dedup.repeated_passages(documents(odd_rows)).collect()
    assert {r.doc_id for r in got} == {5, 6} and all(r.kept == (r.doc_id == 5) for r in got)
    assert paragraph_dedup.repeated_passages(documents([])).collect() == []


# ------------------------------------------------------------ lines

def test_boilerplate_lines(spark):
    html = "<html><!-- x --><script>a<b</script><nav>Home</nav><p>{}</p><br>Foot &copy;</html>"
    rows = [(i, f"http://A.example/{i}", html.format(f"own {i}")) for i in range(4)]
    rows += [(10, "http://b.example:80/", html.format("once")), (11, None, None), (12, "no url", "Home\nHome"),
             (12, "no url", "Home\nHome"), (None, "http://b.example/x", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    lines = line_frequency.page_lines(frame)
    got = {}
    for r in line_frequency.drop_boilerplate(lines).collect():
        got.setdefault((r.page_id, r.host), []).append((r.lines, r.n_lines, r.n_dropped))
    assert got[(0, "a.example")] == [(["own 0"], 3, 2)]
    assert got[(10, "b.example")] == [(["Home", "once", "Foot &copy;"], 3, 0)]
    assert got[(11, None)] == [([], 0, 0)]
    assert got[(12, None)] == [([], 2, 2), ([], 2, 2)]
    assert got[(None, "b.example")] == [([], 0, 0)]
    assert line_frequency.drop_boilerplate(lines.limit(0)).collect() == []
