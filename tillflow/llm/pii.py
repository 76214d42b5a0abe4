"""Personal data: base patterns, and a character tagger that adds what they miss.

The tagger is a bidirectional LSTM over characters with a CRF on top, trained in numpy
from labelled spans: the base spans of a bounded sample of documents, and the same
spans rewritten as people also write them (other separators, no plus sign, spaces
around the at sign).  Its labels are outside, and begin and inside of each kind.

Texts are cut into windows of ``WINDOW`` characters that overlap by half.  Each window is
tagged and decoded by itself; then the windows of a text are reconciled: a character takes
its label from the window in which it lies deepest, and runs of one kind that meet at a
seam become one span.  A tagged span stands if it holds a digit or an at sign, as every
span of these kinds does, and touches no base span.  So the windows that own such a
character come first, and their neighbours only while a run goes on into them: no other
window can take part in a span that stands, and the result is that of tagging all.

Texts are read where they lie: one pass without a shuffle.  Training is one task over the
sample; the model is some thousand numbers.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.shared import ship, slices, texts_of

KINDS = ("email", "ip", "card", "phone")
# Documents that the tagger learns from, windows of each, and all windows.
SAMPLE, WINDOWS_EACH = 1_500, 2
WINDOW, STEP = 96, 48
EMBEDDED, HIDDEN = 12, 16
EPOCHS, BATCH, RATE = 6, 48, 0.02
TAGGED_AT_ONCE = 2_048
TRIGGER = re.compile(r"[0-9@]")

# ---- base patterns ------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does; saying so keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches found from their at signs: the run before it, the domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield "email", begin, free
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    doubled = [d * 2 - 9 if d > 4 else d * 2 for d in map(int, digits[-2::-2])]
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def _shapes(text: str) -> Iterator[tuple[Span, bool]]:
    """Every match of a pattern and whether it passes its check."""
    for span in _emails(text):
        yield span, True
    for m in _IP.finditer(text):
        parts = [part.lstrip("0") for part in m.group().split(".")]
        yield ("ip", *m.span()), all(len(part) < 4 and int(part or 0) <= 255 for part in parts)
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        yield ("card", *m.span()), 16 <= len(digits) <= 19 and luhn(digits)
    for m in _PHONE.finditer(text):
        yield ("phone", *m.span()), 8 <= sum(c.isdigit() for c in m.group()) <= 15


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in the order of the kinds, then of the places."""
    return [span for span, good in _shapes(text) if good]


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


# ---- the tagger ---------------------------------------------------------------

# Character classes: 0 pads, 1 is any character beyond ASCII, the others are ASCII.
CLASSES = 130
LABELS = 1 + 2 * len(KINDS)  # 0 outside, 2k + 1 begins kind k, 2k + 2 goes on


def classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, codes + 2, 1).astype(np.int16)


def labels_of(spans: list[Span], begin: int, end: int) -> np.ndarray:
    out = np.zeros(end - begin, np.int8)
    for kind, start, stop in spans:
        if start < end and stop > begin:
            out[max(start - begin, 0):stop - begin] = 2 * KINDS.index(kind) + 2
            if start >= begin:
                out[start - begin] -= 1
    return out


def _allowed() -> np.ndarray:
    """0 for label pairs that may follow each other, else a large penalty."""
    out = np.zeros((LABELS, LABELS), np.float32)
    for inside in range(2, LABELS, 2):
        out[:, inside] = -1e4
        out[[inside - 1, inside], inside] = 0
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


def _logsum(x, axis):
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


class Tagger:
    """Bidirectional LSTM with CRF.  Windows are (rows, places) of classes, 0 at their ends."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        make = lambda *shape: (rng.standard_normal(shape) * (1 / np.sqrt(shape[0]))).astype(np.float32)
        self.p = {"embed": make(CLASSES, EMBEDDED) * 3, "out": make(2 * HIDDEN, LABELS),
                  "out_bias": np.zeros(LABELS, np.float32), "follow": np.zeros((LABELS, LABELS), np.float32)}
        for side in ("ahead", "back"):
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN:2 * HIDDEN] = 1  # the forget gate begins open
            self.p |= {f"{side}_in": make(EMBEDDED, 4 * HIDDEN), f"{side}_state": make(HIDDEN, 4 * HIDDEN),
                       f"{side}_bias": bias}

    # Arrays run (place, row, ...), so that a step is one contiguous block.

    def _run(self, side: str, ids: np.ndarray, keep: list | None) -> np.ndarray:
        table = self.p["embed"] @ self.p[f"{side}_in"] + self.p[f"{side}_bias"]
        state = self.p[f"{side}_state"]
        h = np.zeros((ids.shape[1], HIDDEN), np.float32)
        c, out = h, np.empty((*ids.shape, HIDDEN), np.float32)
        for t in (range(len(ids)) if side == "ahead" else range(len(ids) - 1, -1, -1)):
            z = table[ids[t]] + h @ state
            gates, g = _sigmoid(z[:, :3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            before_h, before_c = h, c
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            out[t] = h
            if keep is not None:
                keep.append((t, i, f, o, g, before_h, before_c, squashed))
        return out

    def scores(self, ids: np.ndarray, kept: dict | None = None) -> np.ndarray:
        states = [self._run(side, ids, None if kept is None else kept.setdefault(side, []))
                  for side in ("ahead", "back")]
        both = np.concatenate(states, axis=2)
        if kept is not None:
            kept["both"] = both
        return both @ self.p["out"] + self.p["out_bias"]

    def decode(self, windows: np.ndarray) -> np.ndarray:
        """The best label sequence of each window (Viterbi); padding is outside."""
        ids = np.ascontiguousarray(windows.T)
        scores = self.scores(ids)
        scores[ids == 0] += np.where(np.arange(LABELS) == 0, 0, -1e4).astype(np.float32)
        follow = self.p["follow"] + _allowed()
        best, back = scores[0], np.empty((len(ids), ids.shape[1], LABELS), np.int8)
        for t in range(1, len(ids)):
            ways = best[:, :, None] + follow
            back[t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[t]
        out = np.empty(ids.shape, np.int8)
        out[-1] = best.argmax(axis=1)
        rows = np.arange(ids.shape[1])
        for t in range(len(ids) - 1, 0, -1):
            out[t - 1] = back[t][rows, out[t]]
        return out.T

    def learn(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of a character's label, and its slopes."""
        ids, want = np.ascontiguousarray(windows.T), np.ascontiguousarray(labels.T)
        kept: dict = {}
        scores = self.scores(ids, kept)
        places, rows = ids.shape
        live = ids != 0
        follow = self.p["follow"] + _allowed()
        ahead, back = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = scores[0]
        for t in range(1, places):
            step = _logsum(ahead[t - 1][:, :, None] + follow, 1) + scores[t]
            ahead[t] = np.where(live[t][:, None], step, ahead[t - 1])
        for t in range(places - 2, -1, -1):
            step = _logsum(follow + (scores[t + 1] + back[t + 1])[:, None, :], 2)
            back[t] = np.where(live[t + 1][:, None], step, back[t + 1])
        total = _logsum(ahead[-1], 1)
        hot = np.eye(LABELS, dtype=np.float32)[want] * live[:, :, None]
        count = np.float32(live.sum())
        d_scores = (np.exp(ahead + back - total[:, None]) * live[:, :, None] - hot) / count
        d_follow = np.zeros_like(follow)
        for t in range(1, places):
            pairs = (ahead[t - 1][:, :, None] + follow + (scores[t] + back[t])[:, None, :]
                     - total[:, None, None])
            pairs = np.exp(pairs, out=pairs)
            pairs[~live[t]] = 0
            d_follow += pairs.sum(axis=0) - hot[t - 1].T @ hot[t]
        both = live[1:] & live[:-1]
        path = (scores * hot).sum() + (follow[want[:-1], want[1:]] * both).sum()
        slopes = {"follow": np.where(_allowed() < 0, 0, d_follow / count),
                  "out": np.tensordot(kept["both"], d_scores, ((0, 1), (0, 1))),
                  "out_bias": d_scores.sum(axis=(0, 1)), "embed": np.zeros_like(self.p["embed"])}
        d_both = d_scores @ self.p["out"].T
        for number, side in enumerate(("ahead", "back")):
            self._slopes(side, ids, kept[side], d_both[:, :, number * HIDDEN:(number + 1) * HIDDEN], slopes)
        return float((total.sum() - path) / count), slopes

    def _slopes(self, side: str, ids: np.ndarray, kept: list, d_out: np.ndarray, slopes: dict) -> None:
        state = self.p[f"{side}_state"]
        d_state = np.zeros_like(state)
        d_gates = np.empty((*ids.shape, 4 * HIDDEN), np.float32)
        dh = dc = np.zeros((ids.shape[1], HIDDEN), np.float32)
        for t, i, f, o, g, before_h, before_c, squashed in reversed(kept):
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - squashed * squashed)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f),
                                 dh * squashed * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            d_state += before_h.T @ dz
            d_gates[t] = dz
            dh, dc = dz @ state.T, dc * f
        order = np.argsort(ids, axis=None, kind="stable")
        used, begin = np.unique(ids.ravel()[order], return_index=True)
        d_table = np.zeros((CLASSES, 4 * HIDDEN), np.float32)
        d_table[used] = np.add.reduceat(d_gates.reshape(-1, 4 * HIDDEN)[order], begin)
        slopes[f"{side}_state"] = d_state
        slopes[f"{side}_bias"] = d_table.sum(axis=0)
        slopes[f"{side}_in"] = self.p["embed"].T @ d_table
        slopes["embed"] += d_table @ self.p[f"{side}_in"].T

    def fit(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> list[float]:
        """Adam over shuffled batches; the loss of each epoch."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        steps, losses = 0, []
        for epoch in range(epochs):
            order, lost = rng.permutation(len(windows)), []
            for begin in range(0, len(order), BATCH):
                rows = order[begin:begin + BATCH]
                loss, slopes = self.learn(windows[rows], labels[rows])
                lost.append(loss)
                steps += 1
                size = min(1.0, 1.0 / (np.sqrt(sum(float((s * s).sum()) for s in slopes.values())) + 1e-9))
                rate = RATE * (1 - 0.9 * epoch / epochs)
                for name, slope in slopes.items():
                    slope = slope * size
                    first[name] += 0.1 * (slope - first[name])
                    second[name] += 0.01 * (slope * slope - second[name])
                    corrected = first[name] / (1 - 0.9 ** steps)
                    self.p[name] -= (rate * corrected / (np.sqrt(second[name] / (1 - 0.99 ** steps)) + 1e-8)
                                     ).astype(np.float32)
            losses.append(float(np.mean(lost)))
        return losses

    def flat(self) -> list[float]:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)]).astype(float).tolist()

    def load(self, numbers: list[float]) -> Tagger:
        at = 0
        for name in sorted(self.p):
            size = self.p[name].size
            self.p[name] = np.array(numbers[at:at + size], np.float32).reshape(self.p[name].shape)
            at += size
        return self


# ---- training windows ---------------------------------------------------------

def rewritten(kind: str, value: str, rng: random.Random) -> str:
    """``value`` as people also write it, in a form that its base pattern may miss."""
    digits = "".join(c for c in value if c.isdigit())
    if kind == "email":
        name, domain = value.split("@")
        return rng.choice([f"{name} @ {domain}", f"{name}@ {domain}", f"{name} @{domain}"])
    if kind == "ip":
        return value.replace(".", rng.choice([" . ", ". "]))
    if kind == "card":
        mark = rng.choice([".", "  ", " - ", "_"])
        return mark.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    last, middle, area = digits[-4:], digits[-7:-4], digits[-10:-7]
    return rng.choice([f"({area}) {middle}-{last}", f"{area}-{middle}-{last}", f"{area}.{middle}.{last}",
                       f"00{digits[:-10]} {area} {middle} {last}", f"{area} {middle} {last}"])


def _looks_like_one(text: str, span: Span) -> bool:
    """A card number in all but its check digit, an address in all but a part's size."""
    digits = sum(c.isdigit() for c in text[span[1]:span[2]])
    return span[0] == "ip" or span[0] == "card" and 16 <= digits <= 19


def windows_from(text: str, seed: int, most: int = WINDOWS_EACH) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows around digits and at signs, half of them with their spans rewritten.

    Windows over a match that fails its check are left out: such a number looks like a
    card or an address, but is none.
    """
    rng = random.Random(seed)
    shapes = list(_shapes(text))
    spans = [span for span, good in shapes if good]
    doubtful = [span for span, good in shapes if not good and _looks_like_one(text, span)]
    marks = [m.start() for m in TRIGGER.finditer(text)]
    out = []
    for _ in range(most if marks else 0):
        begin = max(0, min(rng.choice(marks) - rng.randrange(WINDOW), len(text) - WINDOW))
        end = min(len(text), begin + WINDOW)
        if any(s[1] < end and s[2] > begin for s in doubtful):
            continue
        piece, inside = text[begin:end], [(k, a - begin, b - begin) for k, a, b in spans if a >= begin and b <= end]
        if inside and rng.random() < 0.5:
            kind, a, b = rng.choice(inside)
            new = rewritten(kind, piece[a:b], rng)
            piece = (piece[:a] + new + piece[b:])[:WINDOW]
            grown = len(new) - (b - a)
            moved = [(k, x + grown * (x > a), y + grown * (x >= a)) for k, x, y in inside]
            cut = [(k, x + begin, y + begin) for k, x, y in moved]
            others = [s for s in spans if (s[1] < begin < s[2])]
            out.append((classes(piece), labels_of(cut + others, begin, begin + len(piece))))
        else:
            out.append((classes(piece), labels_of(spans, begin, end)))
    return out


def padded(rows: list[np.ndarray], kind) -> np.ndarray:
    out = np.zeros((len(rows), WINDOW), kind)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        ranks, found = [], []
        for rank, text in zip(batch.column(0).to_pylist(), texts_of(batch)):
            for pair in windows_from(text, rank):
                ranks.append(rank)
                found.append(pair)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ranks, pa.int64()), pa.array([x for x, _ in found], pa.list_(pa.int16())),
             pa.array([y for _, y in found], pa.list_(pa.int8()))], names=["rank", "classes", "labels"])


def _fit(epochs: int):
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, labels = [], []
        for batch in batches:
            windows += [np.array(x, np.int16) for x in batch.column(1).to_pylist()]
            labels += [np.array(y, np.int8) for y in batch.column(2).to_pylist()]
        tagger = Tagger()
        if windows:
            tagger.fit(padded(windows, np.int16), padded(labels, np.int8), epochs)
            yield pa.RecordBatch.from_arrays([pa.array(tagger.flat(), pa.float64())], names=["weight"])

    return fit


def train(docs: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> list[float]:
    """The tagger's numbers, learned from about ``sample`` documents with a digit or at sign.

    Those with the lowest hash of doc_id and text are taken; equal texts count once.
    """
    ship(docs.sparkSession)
    able = docs.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("text").alias("rank"), "text")
    count = able.count()
    if count > sample:
        able = able.where(F.col("rank") < int(-2**63 + 2**64 * (sample / count)))
    rows = able.dropDuplicates(["rank"]).mapInArrow(
        _sample_windows, "rank long, classes array<short>, labels array<byte>")
    one = rows.repartition(1).sortWithinPartitions("rank", "classes", "labels")
    return [r.weight for r in one.mapInArrow(_fit(epochs), "weight double").collect()]


# ---- tagging ------------------------------------------------------------------

def grid(length: int) -> int:
    """Number of windows of a text; window k begins at ``k * STEP``."""
    return max(0, -(-(length - WINDOW) // STEP)) + 1


def owned(k: int, length: int) -> tuple[int, int]:
    """The places that window k decides: those that lie deeper in it than in its neighbours."""
    margin = (WINDOW - STEP) // 2
    return (k * STEP + margin if k else 0,
            k * STEP + WINDOW - margin if k + 1 < grid(length) else length)


def first_windows(text: str) -> set[int]:
    """The windows that own a digit or an at sign."""
    last, margin = grid(len(text)) - 1, (WINDOW - STEP) // 2
    return {min(max((m.start() - margin) // STEP, 0), last) for m in TRIGGER.finditer(text)}


def reconciled(length: int, labels: dict[int, np.ndarray]) -> list[Span]:
    """Spans of one text from its windows' labels; at a seam a run of one kind goes on."""
    spans: list[Span] = []
    for k in sorted(labels):
        left, right = owned(k, length)
        own = labels[k][left - k * STEP:right - k * STEP]
        for at in np.flatnonzero(own).tolist():
            kind, place = KINDS[(own[at] - 1) // 2], left + at
            last = spans[-1] if spans else None
            if last and last[2] == place and last[0] == kind and (own[at] % 2 == 0 or at == 0):
                spans[-1] = (kind, last[1], place + 1)
            else:
                spans.append((kind, place, place + 1))
    return spans


def _reached(length: int, k: int, labels: np.ndarray) -> list[int]:
    """Neighbours into which a run of window k's own places may go on."""
    left, right = owned(k, length)
    return ([k - 1] if k and labels[left - k * STEP] else []) + \
        ([k + 1] if k + 1 < grid(length) and labels[right - 1 - k * STEP] else [])


def added_spans(text: str, tagged: list[Span], base: list[Span]) -> list[Span]:
    """Tagged spans without blanks at their ends, with a digit or at sign, that touch no base span."""
    out = []
    for kind, start, end in tagged:
        piece = text[start:end]
        start += len(piece) - len(piece.lstrip())
        end -= len(piece) - len(piece.rstrip())
        if start < end and TRIGGER.search(text, start, end) \
                and not any(a < end and b > start for _, a, b in base):
            out.append((kind, start, end))
    return out


def tag(texts: list[str], tagger: Tagger) -> list[list[Span]]:
    """The tagger's reconciled spans of each text, windows of all texts decoded together.

    Begins with the windows that own a digit or at sign and goes on to a neighbour while a
    run reaches it.
    """
    labels: list[dict[int, np.ndarray]] = [{} for _ in texts]
    todo = [(row, k) for row, text in enumerate(texts) for k in sorted(first_windows(text))]
    while todo:
        reached = set()
        for begin in range(0, len(todo), TAGGED_AT_ONCE):
            part = todo[begin:begin + TAGGED_AT_ONCE]
            windows = padded([classes(texts[row][k * STEP:k * STEP + WINDOW]) for row, k in part], np.int16)
            for (row, k), found in zip(part, tagger.decode(windows)):
                labels[row][k] = found
                reached |= {(row, near) for near in _reached(len(texts[row]), k, found)}
        todo = sorted((row, k) for row, k in reached if k not in labels[row])
    return [reconciled(len(text), own) for text, own in zip(texts, labels)]


def spans_of(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(text) for text in texts]
    tagged = tag(texts, tagger) if tagger else [[] for _ in texts]
    return [(b, added_spans(text, t, b)) for text, t, b in zip(texts, tagged, base)]


def _digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def _find(numbers):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger().load(numbers.value) if numbers.value else None
        none = ([0] * len(KINDS), _digest([]), "")
        for batch in slices(batches, "text"):
            column = batch.column(batch.schema.get_field_index("text"))
            held = pc.fill_null(pc.match_substring_regex(column, "[0-9@]"), False)
            rows = pc.indices_nonzero(held).to_pylist()
            texts = column.take(pa.array(rows, pa.int64())).to_pylist()
            out = [none] * batch.num_rows
            for row, (base, added) in zip(rows, spans_of(texts, tagger)):
                counts = [sum(span[0] == kind for span in base) for kind in KINDS]
                out[row] = (counts, _digest(base), joined(base + added))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[0][k] for r in out], pa.int64()) for k in range(len(KINDS))],
                 pa.array([r[1] for r in out]), pa.array([r[2] for r in out])],
                names=["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"])

    return run


def find_personal_data(docs: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of ``docs``.

    Places count code points, ends are exclusive.  ``n_*`` and the hash follow from the base
    patterns alone; ``spans`` lists them and what the tagger adds, by kind, then place.  A null or
    empty text has no spans; where no text holds a digit or at sign, nothing is learned
    and nothing added.  Repeated rows get equal results, null doc_ids stay, other columns are
    ignored, an empty table gives no rows.
    """
    numbers = docs.sparkSession.sparkContext.broadcast(train(docs, sample, epochs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = ", ".join(f"n_{kind} long" for kind in KINDS)
    return rows.mapInArrow(_find(numbers), f"doc_id long, {counts}, base_sha256 string, spans string")
