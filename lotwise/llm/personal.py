"""Personal data by a semi-Markov conditional random field.

Base patterns mark emails, addresses, cards and phones; their spans always stand. Beside
them a semi-Markov CRF judges whole candidate segments: its features look at a segment
as a whole (digits, groups, separators, check digit, what stands left and right), and a
forward pass over the segments' ends sums or maximises over all ways to lay bounded,
non-overlapping segments of the four kinds into a stretch of text, so boundaries and
kinds are chosen together. Its spans are added where they touch no base span: phones
without a plus sign, emails with blanks around the sign, and the like.

The weights are trained by maximum likelihood on stretches around digits and signs taken
from the documents, with the base spans as labels and with rewritten copies of them as
further examples. The training set is the one bounded sample: ``MOST_STRETCHES`` of at
most ``STRETCH`` characters, those of lowest hash. Every document is then searched whole.

Edge cases: null or empty texts have no spans; a table without candidates trains nothing
and only base spans remain; equal texts get equal spans; an overlong run of digits is
cut into segments of at most ``MOST_GROUPS`` groups; null ids and other columns are kept
or ignored as they are.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
MOST_STRETCHES = 1500
STRETCH = 160
MOST_GROUPS = 6
EPOCHS = 6
RATE = 0.3
DECAY = 1e-3

# Fixed patterns of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TRIGGER = re.compile(r"[0-9@]")
DIGITS = re.compile(r"[0-9]+")
# the address pattern, tried once for each run of digits: later digits of a run match
# only where its first does
IP_RUN = re.compile(r"(?<![0-9])" + IP.pattern)
# words with digits or signs; every word is tried once, from its first character
STRETCHES = re.compile(
    r"(?<!\S)(?:\S*[0-9@]\S*(?:\x20\S*[0-9@(]\S*)*|\S*[(\[]at[)\]]\S*)"
)
RUN = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])*")
MAIL = re.compile(r"[\w.%+-]{1,64}\x20?(?:@|\(at\)|\[at\])\x20?[\w-]{1,63}(?:\.[\w-]{1,63})*")
SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "base_sha256 string, spans string"
)
Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    out = []
    if "@" in text:
        out += [(*m.span(), "email") for m in EMAIL.finditer(text)]
    if DIGITS.search(text):
        out += [(*m.span(), "ip") for m in IP_RUN.finditer(text) if all(map(small, m[0].split(".")))]
        for m in CARD.finditer(text):
            digits = "".join(DIGITS.findall(m[0]))
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
                    out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> Iterator[Span]:
    """Segments that could be of a kind, with the kind."""
    if "@" in text or "(at)" in text or "[at]" in text:
        for m in MAIL.finditer(text):
            a, b = m.span()
            yield a, b, "email"
            cut = b
            while "." in text[a:cut] and text.rfind(".", a, cut) > max(text.rfind(x, a, b) for x in "@)]"):
                cut = text.rfind(".", a, cut)
                yield a, cut, "email"
    for run in RUN.finditer(text):
        groups = [m.span() for m in DIGITS.finditer(text, *run.span())]
        for i in range(len(groups)):
            for j in range(i, min(len(groups), i + MOST_GROUPS)):
                begin, end = groups[i][0], groups[j][1]
                size = sum(y - x for x, y in groups[i : j + 1])
                starts = [begin]
                if begin > run.start() and text[begin - 1] in "+(":
                    starts.append(begin - 1)
                    if begin - 1 > run.start() and text[begin - 2 : begin] == "+(":
                        starts.append(begin - 2)
                for a in starts:
                    if 7 <= size <= 15:
                        yield a, end, "phone"
                    if 12 <= size <= 19 and a == begin:
                        yield a, end, "card"
                    if j - i == 3 and a == begin and text[begin:end].count(".") == 3:
                        yield a, end, "ip"


def side(c: str) -> str:
    return "edge" if not c else "digit" if c.isdigit() else "letter" if c.isalpha() else (
        "blank" if c.isspace() else c if c in "+-.@_%()\"'=:/#" else "other"
    )


def features(text: str, span: Span) -> list[str]:
    """What a whole segment looks like, and what stands beside it."""
    a, b, kind = span
    own = text[a:b]
    groups = [len(g) for g in DIGITS.findall(own)]
    out = [kind, f"left {side(text[a - 1 : a])}", f"right {side(text[b : b + 1])}"]
    if kind == "email":
        name, _, rest = own.replace("(at)", "@").replace("[at]", "@").partition("@")
        labels = rest.strip().split(".")
        out += [
            f"labels {min(len(labels), 4)}",
            f"top letters {labels[-1].isalpha()} {min(len(labels[-1]), 4)}",
            f"blank {' ' in own}",
            f"name {bool(name.strip('._%+- '))}",
        ]
    else:
        n = sum(groups)
        out += [
            f"digits {n}",
            f"groups {'-'.join(map(str, groups[:MOST_GROUPS]))}",
            f"count {len(groups)}",
            f"first {own[0] if own[0] in '+(' else 'digit'}",
            f"marks {''.join(sorted(set(own) - set('0123456789')))}",
        ]
        if kind == "card":
            out.append(f"luhn {luhn(''.join(DIGITS.findall(own)))}")
        if kind == "ip":
            out.append(f"small {all(map(small, own.split('.')))}")
        if kind == "phone":
            out.append(f"paired {own.count('(') == own.count(')')}")
    return [f"{kind}: {x}" for x in out]


def score(weights: dict[str, float], names: list[str]) -> float:
    return sum(weights.get(x, 0.0) for x in names)


def add(x: float, y: float) -> float:
    top = max(x, y)
    return top + math.log(math.exp(x - top) + math.exp(y - top))


def lattice(spans: list[Span]) -> tuple[list[int], dict[int, int]]:
    places = sorted({p for a, b, _ in spans for p in (a, b)})
    return places, {p: i for i, p in enumerate(places)}


def marginals(spans: list[Span], scores: list[float]) -> list[float]:
    """Probability of each segment over all layouts of segments that don't overlap."""
    places, at = lattice(spans)
    n = len(places)
    ahead, back = [0.0] * n, [0.0] * n
    ends: list[list[int]] = [[] for _ in range(n)]
    starts: list[list[int]] = [[] for _ in range(n)]
    for k, (a, b, _) in enumerate(spans):
        ends[at[b]].append(k)
        starts[at[a]].append(k)
    for i in range(1, n):
        ahead[i] = ahead[i - 1]
        for k in ends[i]:
            ahead[i] = add(ahead[i], ahead[at[spans[k][0]]] + scores[k])
    for i in range(n - 2, -1, -1):
        back[i] = back[i + 1]
        for k in starts[i]:
            back[i] = add(back[i], back[at[spans[k][1]]] + scores[k])
    return [
        math.exp(min(0.0, ahead[at[a]] + s + back[at[b]] - ahead[-1]))
        for (a, b, _), s in zip(spans, scores, strict=True)
    ]


def best_layout(spans: list[Span], scores: list[float]) -> list[Span]:
    """The segments of the best layout; of equal ones the one with fewer segments."""
    places, at = lattice(spans)
    ends: list[list[int]] = [[] for _ in places]
    for k, (_, b, _) in enumerate(spans):
        ends[at[b]].append(k)
    top, last = [0.0] * len(places), [-1] * len(places)
    for i in range(1, len(places)):
        top[i] = top[i - 1]
        for k in ends[i]:
            value = top[at[spans[k][0]]] + scores[k]
            if value > top[i]:
                top[i], last[i] = value, k
    out, i = [], len(places) - 1
    while i > 0:
        if last[i] < 0:
            i -= 1
        else:
            out.append(spans[last[i]])
            i = at[spans[last[i]][0]]
    return out[::-1]


def beside(text: str, at: int, step: int) -> int:
    """Where the word before (step -1) or after (1) ends that at most two blanks part from ``at``."""
    char = lambda i: text[i - 1 : i] if step < 0 else text[i : i + 1]
    end = at
    while char(end) == " " and abs(end - at) < 2:
        end += step
    if not char(end) or char(end).isspace():
        return at
    while char(end) and not char(end).isspace():
        end += step
    return end


def stretches(text: str) -> Iterator[tuple[int, str]]:
    """Start and text of the stretches around digits and signs: whole words, those beside
    them and a character of white space on each side. Words that two matches share join them."""
    a = b = -1
    for m in STRETCHES.finditer(text):
        # what lies before the last end was walked over once; it is not walked again
        own = m.start() if m.start() <= b else beside(text, m.start(), -1)
        if b >= 0 and own >= b and m.start() > b:
            yield max(a - 1, 0), text[max(a - 1, 0) : b + 1]
            b = -1
        if b < 0:
            a = own
        b = max(b, beside(text, m.end(), 1)) if m.end() > b else b
    if b >= 0:
        yield max(a - 1, 0), text[max(a - 1, 0) : b + 1]


def rewritten(text: str, labels: list[Span], draw: random.Random) -> tuple[str, list[Span]]:
    """A copy of a stretch, its first span in another spelling of the same kind."""
    (a, b, kind), rest = labels[0], labels[1:]
    own = text[a:b]
    if kind == "phone":
        new = draw.choice([re.sub(r"^\+[0-9]+[ .-]?(?=[(0-9])", "", own), own.lstrip("+")])
        if sum(map(len, DIGITS.findall(new))) < 7:
            new = own
    elif kind == "email":
        new = own.replace("@", draw.choice([" @ ", "(at)", "[at]"]))
    else:
        new = own
    shift = len(new) - len(own)
    moved = [(x + shift, y + shift, k) for x, y, k in rest if x >= b]
    return text[:a] + new + text[b:], [(a, a + len(new), kind), *moved]


def train(examples: list[str], epochs: int = EPOCHS, seed: int = 7) -> dict[str, float]:
    """Weights by gradient steps on the likelihood of the labelled layouts."""
    draw, data = random.Random(seed), []
    for text in examples:
        labels = base_spans(text)
        data.append((text, labels))
        if labels and labels[0][2] in ("phone", "email"):
            data.append(rewritten(text, labels, draw))
    prepared = []
    for text, labels in data:
        spans = list(dict.fromkeys(candidates(text)))
        if spans:
            names = [features(text, s) for s in spans]
            prepared.append((names, spans, [float(s in labels) for s in spans]))
    weights: dict[str, float] = {}
    for epoch in range(epochs):
        draw.shuffle(prepared)
        rate = RATE / (1 + epoch)
        for names, spans, truth in prepared:
            chance = marginals(spans, [score(weights, x) for x in names])
            for own, p, t in zip(names, chance, truth, strict=True):
                if abs(t - p) > 1e-4:
                    for x in own:
                        w = weights.get(x, 0.0)
                        weights[x] = w + rate * (t - p - DECAY * w)
    return weights


def merged(spans: list[Span]) -> tuple[list[int], list[int]]:
    """Starts and ends of what spans, given by start, cover together."""
    starts, ends = [], []
    for a, b, _ in spans:
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def touches(a: int, b: int, covered: tuple[list[int], list[int]]) -> bool:
    starts, ends = covered
    i = bisect.bisect_right(ends, a)
    return i < len(starts) and starts[i] < b


def spans_of(text: str, weights: dict[str, float], base: list[Span]) -> list[Span]:
    """Base spans and those that the model adds, in order."""
    added, covered = [], merged(base)
    if weights:
        for start, own in stretches(text):
            spans = [
                s for s in dict.fromkeys(candidates(own))
                if not touches(s[0] + start, s[1] + start, covered)
            ]
            if spans:
                scores = [score(weights, features(own, s)) for s in spans]
                added += [(a + start, b + start, k) for a, b, k in best_layout(spans, scores)]
    return sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def examples_of(documents: DataFrame, most: int = MOST_STRETCHES) -> list[str]:
    """At most ``most`` stretches of at most STRETCH characters, by lowest hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = {
                s
                for text in batch.column(0).to_pylist()
                if text and TRIGGER.search(text)
                for _, s in stretches(text)
                if len(s) <= STRETCH
            }
            yield pa.RecordBatch.from_arrays([pa.array(sorted(own), pa.string())], names=["stretch"])

    rows = documents.select("text").mapInArrow(run, "stretch string").distinct()
    chosen = rows.orderBy(F.xxhash64("stretch"), "stretch").limit(most).collect()
    return [r["stretch"] for r in chosen]


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def found(documents: DataFrame, weights: dict[str, float]) -> DataFrame:
    """One row per document: base counts and digest, and all spans."""
    shared = documents.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                base = base_spans(text) if TRIGGER.search(text) else []
                counts.append([sum(s[2] == k for s in base) for k in KINDS])
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                spans.append(written(spans_of(text, weights, base)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))),
                    pa.array(digests, pa.string()),
                    pa.array(spans, pa.string()),
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)


def personal_data(documents: DataFrame) -> DataFrame:
    """Train on the bounded sample, then search every document."""
    return found(documents, train(examples_of(documents)))
