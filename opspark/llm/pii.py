"""Personal data: base patterns, and a semi-Markov conditional random field that adds spans.

The base patterns (email, IP address, card number, phone number) are searched leftmost and without overlaps in every
whole text; matches that fail their check are dropped. Their spans always stay.

The field looks at the stretches of a text around units that hold a digit or an ``@``. A unit is a run of characters
between white space, without the punctuation around it. A candidate segment is a run of up to ``MOST_UNITS`` units with
a type, and it is scored as a whole: digits in it, groups, check sum, octets, ``@`` and what follows it, signs, brackets.
Dynamic programming over segments of bounded length chooses boundaries and types of a stretch together. An entity is
added if its posterior (the probability of exactly this segment, from the forward and backward sums) is at least
``CERTAIN`` and no base span overlaps it.

The weights are learned by maximum likelihood on at most ``MAX_STRETCHES`` distinct stretches, those with the smallest hashes. The
valid base matches in them are the labels, and each match is also written in ways that the patterns miss (blanks and brackets, a
missing plus, a spelled dot, other signs between digits) and as near misses, which are no entities. So the field learns
forms beyond the patterns from the texts themselves.

A null text is empty and has no spans. Rows are independent. Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .texts import map_texts, slices

KINDS = ["email", "ip", "card", "phone"]

#: Fixed: the base patterns.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Units and characters of an entity, stretches of the fit and its steps, the least posterior of an added span, units whose features are held at once.
MOST_UNITS, MOST_CHARS, MAX_STRETCHES, STEPS, CERTAIN, BLOCK = 7, 120, 300, 60, 0.9, 200

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    twice = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """(start, end, kind number) of the base matches, by start and kind."""
    found: list[Span] = []
    if "@" in text:
        found += [(a, b, 0) for a, b in emails(text)]
    if ANY_DIGIT.search(text):
        found += [(a, b, 1) for a, b in addresses(text) if all(octet(p) for p in text[a:b].split("."))]
        for m in CARD.finditer(text):
            d = digits_of(m.group()) if m.end() - m.start() < 64 else ""
            if 14 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            found += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(digits_of(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of ``EMAIL``, in linear time: an ``@`` can only end the run of local characters before it, so each is looked at once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """The matches of ``IP``, in linear time: if none starts with a run of digits, none starts inside it."""
    run = DIGITS.search(text)
    while run:
        m = IP.match(text, run.start()) if run.end() < len(text) and text[run.end()] == "." else None
        if m:
            yield m.start(), m.end()
        run = DIGITS.search(text, m.end() if m else run.end())


#: Parts of the base patterns.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
DIGITS = re.compile("[0-9]+")
ANY_DIGIT = re.compile("[0-9]")


def octet(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) < 4 and int(digits or "0") <= 255


UNIT = re.compile(r"\S+")
AROUND = "\"'`,;:!?()[]{}<>|=*#$%&."
HINT = re.compile("[0-9@]")


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """A run of characters without the punctuation around it; brackets that belong together stay."""
    closes = text.rfind(")", a, b)
    while a < b and text[a] in AROUND and not (text[a] == "(" and a < closes):
        a += 1
    opens = text.find("(", a, b)
    while b > a and text[b - 1] in AROUND and not (text[b - 1] == ")" and 0 <= opens < b):
        b -= 1
    return a, b


def around(text: str, a: int, b: int, done: int) -> list[tuple[int, int]]:
    """A run of characters at a hint; if it has an ``@`` but is no whole address, with the run before it and the two after it."""
    out = [(a, b)]
    left, right = trimmed(text, a, b)
    if right - left <= MOST_CHARS and "@" in text[left:right] and not EMAIL.fullmatch(text, left, right):
        end = a
        while end > done and text[end - 1].isspace():
            end -= 1
        start = end
        while start > done and end - start <= MOST_CHARS and not text[start - 1].isspace():
            start -= 1
        if done <= start < end <= start + MOST_CHARS:
            out.insert(0, (start, end))
        for _ in range(2):
            if m := UNIT.search(text, out[-1][1], out[-1][1] + 2 * MOST_CHARS):
                out.append((m.start(), m.end()))
    return out


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """The units (start, end) around those with a digit or ``@``: such units with gaps of at most one other unit."""
    if not HINT.search(text):
        return
    current: list[tuple[int, int]] = []
    at = 0
    for hint in HINT.finditer(text):
        if hint.start() < at:
            continue
        # The white-space free run around the hint.
        a = hint.start()
        while a > at and not text[a - 1].isspace():
            a -= 1
        space = SPACE.search(text, hint.start())
        b = space.start() if space else len(text)
        for x, y in around(text, a, b, at):
            left, right = trimmed(text, x, y)
            gap = text[current[-1][1] : left] if current else ""
            if current and (len(gap.split()) > 1 or len(gap) > 24):
                yield current
                current = []
            elif current:
                # A unit between, but not the punctuation of its neighbours.
                current += [m.span() for m in UNIT.finditer(text, current[-1][1], left) if m.start() > current[-1][1] and m.end() < left][:1]
            if right > left:
                current.append((left, right))
            at = max(at, y)
    if current:
        yield current


SPACE = re.compile(r"\s")

FEATURES = 36

SPELLED = [(re.compile(r"(?i)\bdot\b"), "."), (re.compile(r"(?i)\bat\b"), "@"), (re.compile(r"[\s\[\](){}<>]+"), "")]
PHONE_LIKE = re.compile(r"[0-9+\s().\-/]+")


def features(text: str, start: int, end: int, units: int) -> list[float]:
    """What a whole candidate span looks like, as it stands and with spelled signs, blanks and brackets put in order."""
    s = text[start:end]
    d = digits_of(s)
    n = len(d)
    letters = sum(c.isalpha() for c in s)
    parts = s.split(".")
    numeric = [p for p in parts if p.isascii() and p.isdigit()]
    local, at, domain = s.partition("@")
    before = text[max(0, start - 12) : start].lower()
    plain = len(s) - n - letters
    order = s
    for pattern, sign in SPELLED:
        order = pattern.sub(sign, order)
    four = order.split(".")
    four = len(four) == 4 and all(p.isascii() and p.isdigit() and octet(p) for p in four)
    mail = "@" in order and EMAIL.fullmatch(order) is not None
    groups = [len(g) for g in DIGITS.findall(s)]
    signs = {c for c in s if not c.isalnum()}
    return [
        1.0,
        float(units),
        float(units > 1),
        float(n == 0),
        float(0 < n < 7),
        float(7 <= n < 10),
        float(10 <= n < 14),
        float(14 <= n <= 19),
        float(n > 19),
        float(letters == 0),
        float(letters > n),
        float(0 < letters <= n),
        float(bool(at) and bool(local) and "." in domain.strip(".")),
        float(s.count("@") > 1 or (bool(at) and not local)),
        float(bool(at) and " " in s),
        float(len(parts) == 4 and len(numeric) == 4),
        float(len(parts) == 4 and len(numeric) == 4 and all(octet(p) for p in numeric)),
        float(len(parts) > 4 or (len(parts) in (2, 3) and len(numeric) == len(parts))),
        float(14 <= n <= 19 and luhn(d)),
        float(14 <= n <= 19 and not luhn(d)),
        float(s.startswith("+")),
        float("+" in s[1:]),
        float("(" in s and ")" in s),
        float("-" in s),
        float(plain > n + letters),
        float(before.rstrip(" \"'").endswith("=")),
        float(four),
        float(four and units > 1),
        float(mail),
        float(mail and units > 1),
        float(14 <= n <= 19 and luhn(d) and letters == 0 and len(set(groups[:-1])) <= 1 and max(groups) <= 6),
        float(14 <= n <= 19 and len(signs - set(" ")) > 1),
        float(10 <= n <= 13 and groups[-1:] == [4] and groups[-2:-1] == [3] and PHONE_LIKE.fullmatch(s) is not None),
        float(10 <= n <= 15 and groups[-1:] == [4] and (d[0] in "1" or d.startswith("00"))),
        float(10 <= n <= 15 and len(groups) < 3),
        float(len(groups) > 5),
    ]


Lattice = tuple[int, np.ndarray, list[tuple[int, int]]]


def candidates(units: list[tuple[int, int]], at: int, stop: int) -> list[tuple[int, int]]:
    """(first, end) units of the segments that begin at the units ``at`` to ``stop``, within the longest entity."""
    return [(i, j) for i in range(at, stop) for j in range(i + 1, min(i + MOST_UNITS, len(units)) + 1) if units[j - 1][1] - units[i][0] <= MOST_CHARS]


def lattice(text: str, units: list[tuple[int, int]]) -> Lattice:
    """Number of units, features of all candidate segments, and their (first, end) units."""
    places = candidates(units, 0, len(units))
    return len(units), np.array([features(text, units[i][0], units[j - 1][1], j - i) for i, j in places]), places


def sums(n: int, places: list[tuple[int, int]], scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward and backward log sums over all segmentations; a unit outside entities counts zero."""
    each = np.logaddexp.reduce(scores, axis=1)
    forward, backward = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    forward[0] = backward[n] = 0.0
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    starts: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for (i, j), s in zip(places, each.tolist()):
        ends[j].append((i, s))
        starts[i].append((j, s))
    for j in range(1, n + 1):
        terms = [forward[j - 1]] + [forward[i] + s for i, s in ends[j]]
        top = max(terms)
        forward[j] = top + np.log(sum(np.exp(t - top) for t in terms))
    for i in range(n - 1, -1, -1):
        terms = [backward[i + 1]] + [backward[j] + s for j, s in starts[i]]
        top = max(terms)
        backward[i] = top + np.log(sum(np.exp(t - top) for t in terms))
    return forward, backward, float(forward[n])


def posteriors(one: Lattice, weights: np.ndarray) -> np.ndarray:
    """The probability of each candidate segment with each type."""
    n, x, places = one
    scores = x @ weights
    forward, backward, total = sums(n, places, scores)
    i, j = np.array(places).T
    return np.exp(scores + (forward[i] + backward[j] - total)[:, None])


def best(one: Lattice, weights: np.ndarray) -> list[tuple[int, int]]:
    """The most probable segmentation: (candidate segment, type) of its entities."""
    n, x, places = one
    scores = x @ weights
    kinds, top = scores.argmax(axis=1), scores.max(axis=1)
    score, back = [0.0] * (n + 1), [-1] * (n + 1)
    ends: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (_, j) in enumerate(places):
        ends[j].append(k)
    for j in range(1, n + 1):
        score[j] = score[j - 1]
        for k in ends[j]:
            s = score[places[k][0]] + top[k]
            if s > score[j]:
                score[j], back[j] = s, k
    out, j = [], n
    while j:
        if back[j] < 0:
            j -= 1
        else:
            out.append((back[j], int(kinds[back[j]])))
            j = places[back[j]][0]
    return out[::-1]


def entities(text: str, units: list[tuple[int, int]], weights: np.ndarray) -> list[tuple[int, int, int, float]]:
    """What ``best`` and ``posteriors`` say of a stretch of any length: (first unit, end unit, type, posterior) of its entities.

    Features are held for ``BLOCK`` units at a time; a unit leaves some hundred bytes of scores and sums.
    """
    n = len(units)
    each, top = np.full((n, MOST_UNITS), -np.inf), np.full((n, MOST_UNITS), -np.inf)
    kinds = np.zeros((n, MOST_UNITS), np.int8)
    for at in range(0, n, BLOCK):
        places = candidates(units, at, min(at + BLOCK, n))
        if not places:
            continue
        scores = np.array([features(text, units[i][0], units[j - 1][1], j - i) for i, j in places]) @ weights
        i, j = np.array(places).T
        each[i, j - i - 1] = np.logaddexp.reduce(scores, axis=1)
        top[i, j - i - 1] = scores.max(axis=1)
        kinds[i, j - i - 1] = scores.argmax(axis=1)
    forward, backward, score = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    width = np.zeros(n + 1, np.int8)
    for j in range(1, n + 1):
        first = max(0, j - MOST_UNITS)
        i = np.arange(first, j)
        w = j - i - 1
        terms = np.append(forward[i] + each[i, w], forward[j - 1])
        forward[j] = np.logaddexp.reduce(terms)
        ways = score[i] + top[i, w]
        k = int(ways.argmax())
        score[j] = score[j - 1]
        if ways[k] > score[j]:
            score[j], width[j] = ways[k], j - first - k
    chosen, j = [], n
    while j:
        if width[j]:
            chosen.append((j - int(width[j]), j))
        j -= int(width[j]) or 1
    if not chosen:
        return []
    for i in range(n - 1, -1, -1):
        last = min(i + MOST_UNITS, n)
        terms = np.append(backward[i + 1 : last + 1] + each[i, : last - i], backward[i + 1])
        backward[i] = np.logaddexp.reduce(terms)
    return [(i, j, int(kinds[i, j - i - 1]), float(np.exp(top[i, j - i - 1] + forward[i] + backward[j] - forward[n]))) for i, j in chosen[::-1]]


def train(examples: list[tuple[str, list[tuple[int, int]], list[Span]]]) -> np.ndarray:
    """Weights (feature, type) by gradient ascent on the likelihood of the labelled segmentations."""
    data = []
    for text, units, spans in examples:
        one = lattice(text, units)
        gold = np.zeros((len(one[2]), len(KINDS)))
        label = {(a, b): k for a, b, k in spans}
        for c, (i, j) in enumerate(one[2]):
            k = label.get((units[i][0], units[j - 1][1]))
            if k is not None:
                gold[c, k] = 1
        data.append((one, gold))
    weights = np.zeros((FEATURES, len(KINDS)))
    weights[0] = -4.0
    size = np.full_like(weights, 1e-6)
    for _ in range(STEPS):
        slope = -0.02 * weights
        for one, gold in data:
            slope += one[1].T @ (gold - posteriors(one, weights))
        size += slope**2
        weights += 1.0 * slope / np.sqrt(size)
    return weights


def _digits_like(text: str, shape: str, offset: int = 0) -> str:
    """The digits of a text put into a shape, where each ``#`` takes the next one and ``*`` all that are left."""
    d, out = list(digits_of(text))[offset:], []
    for c in shape:
        if c == "#":
            out.append(d.pop(0) if d else "")
        elif c == "*":
            out += d
            d = []
        else:
            out.append(c)
    return "".join(out)


def variants(kind: int, match: str) -> list[tuple[str, bool]]:
    """Ways to write a match that the base patterns miss, and near misses that are none (False)."""
    if kind == 0:
        local, _, domain = match.partition("@")
        host, _, top = domain.rpartition(".")
        return [(f"{local} @ {domain}", True), (f"{local}@{host} dot {top}", True), (f"{local} [@] {domain}", True), (f"{local}@{host} . {top}", True), (f"{local} @ {host.partition('.')[0]}", False)]
    if kind == 1:
        p = match.split(".")
        return [("[.]".join(p), True), (" . ".join(p), True), (" dot ".join(p), True), (f"{p[0]}.{p[1]} .{p[2]}.{p[3]}", True), (" . ".join([*p[:3], "999"]), False)]
    if kind == 2:
        d = digits_of(match)
        wrong = d[:-1] + str((int(d[-1]) + 1) % 10)
        shapes = [("####.####.####.*", True), ("####/####/####/*", True), ("####  ####  ####  *", True), ("####_####_####_*", True)]
        return [(_digits_like(d, s), ok) for s, ok in shapes] + [(_digits_like(wrong, "####.####.####.*"), False), (_digits_like(wrong, "####  ####  ####  *"), False)]
    d = digits_of(match)
    country, rest = d[:-10], d[-10:]
    shapes = [(f"{country} (###) ###-####", True), ("(###) ###-####", True), (f"00{country}-###-###-####", True), (f"{country}.###.###.####", True), ("###/#######", False), ("######.####", False)]
    return [(_digits_like(rest, s), ok) for s, ok in shapes]


def varied(piece: str, units: list[tuple[int, int]], spans: list[Span]) -> list[tuple[str, list[tuple[int, int]], list[Span]]]:
    """Examples in which one match of a stretch is written in another way, with the same text around it."""
    out = []
    for a, b, kind in spans:
        if any(x < b and a < y for x, y, k in spans if (x, y, k) != (a, b, kind)):
            continue
        for new, good in variants(kind, piece[a:b]):
            text = piece[:a] + new + piece[b:]
            base = base_spans(text)
            # What the patterns find in it anyway teaches nothing new.
            if any(x < a + len(new) and a < y for x, y, _ in base):
                continue
            gold = sorted([*base, (a, a + len(new), kind)]) if good else base
            for found in stretches(text):
                if found[0][0] <= a < found[-1][1] and found[-1][1] - found[0][0] <= 2000:
                    ends = {e for _, e in found}
                    starts = {s for s, _ in found}
                    out.append((text, found, [s for s in gold if s[0] in starts and s[1] in ends]))
    return out


def learn(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Fits the weights on a bounded sample of the stretches of the documents' texts."""
    rows = docs.select(F.col(f"`{text}`").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each task, the first distinct stretches in order of a hash of their words, cut out with some text before them."""
        import xxhash

        held: dict[tuple[int, str], list[int]] = {}
        for batch in batches:
            for _, part in slices(batch.column(0)):
                for t in part:
                    for units in stretches(t):
                        if len(units) <= 24 and units[-1][1] - units[0][0] <= 2000:
                            start, end = max(0, units[0][0] - 12), units[-1][1] + 1
                            piece = t[start:end]
                            key, ends = (xxhash.xxh64_intdigest(piece.encode(), 7) >> 1, piece), [x - start for u in units for x in u]
                            held[key] = min(held.get(key, ends), ends)
                held = {key: held[key] for key in sorted(held)[:MAX_STRETCHES]}
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in held], pa.int64()), pa.array([piece for _, piece in held]), pa.array(list(held.values()), pa.list_(pa.int32()))],
                names=["h", "piece", "ends"],
            )

    schema = StructType.fromDDL("h long, piece string, ends array<int>")
    sample = rows.mapInArrow(gather, schema).groupBy("h", "piece").agg(F.min("ends").alias("ends")).orderBy("h", "piece").limit(MAX_STRETCHES).collect()
    examples = []
    for r in sample:
        units = list(zip(r.ends[::2], r.ends[1::2]))
        # A match at the edge of the piece may go on in the text, so it is no label there; the stretch then is left out.
        spans = base_spans(r.piece)
        if all(b < len(r.piece) or r.piece[b - 1 :].isspace() or b == units[-1][1] for _, b, _ in spans):
            examples.append((r.piece, units, spans))
            examples += varied(r.piece, units, spans)
    return train(examples) if examples else np.vstack([np.full((1, len(KINDS)), -20.0), np.zeros((FEATURES - 1, len(KINDS)))])


def all_spans(text: str, weights: np.ndarray) -> tuple[list[Span], list[Span]]:
    """The base spans, and these with the ones the field adds."""
    base = base_spans(text)
    starts, reach = [s[0] for s in base], list(accumulate((s[1] for s in base), max))

    def furthest(before: int) -> int:
        """The largest end of the base spans that start before a place."""
        k = bisect_left(starts, before)
        return reach[k - 1] if k else -1

    added: list[Span] = []
    for units in stretches(text):
        if all(furthest(u[0] + 1) >= u[1] for u in units):
            continue  # nothing outside the base spans
        for i, j, kind, p in entities(text, units, weights):
            a, b = units[i][0], units[j - 1][1]
            if p >= CERTAIN and furthest(b) <= a:
                added.append((a, b, kind))
    return base, sorted(base + added, key=lambda s: (s[0], s[2])) if added else base


SPAN = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType())]))
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, weights: np.ndarray, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns with ``base`` and ``spans``: arrays of (kind, start, end) by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def rows(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[k], "start": a, "end": b} for a, b, k in spans]

    def make() -> Callable:
        def run(texts: list[str | None]) -> list[pa.Array]:
            found = [all_spans(t or "", shared.value) for t in texts]
            return [pa.array([rows(f[i]) for f in found], SPAN_ARROW) for i in (0, 1)]

        return run

    return map_texts(docs, text, keep if keep is not None else docs.columns, [("base", SPAN), ("spans", SPAN)], make)


def redact(docs: DataFrame, weights: np.ndarray, text: str = "text", name: str = "redacted") -> DataFrame:
    """Adds the text with each span replaced by its kind in brackets; a null text stays null. Overlaps go with the first."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def clean(t: str | None) -> str | None:
        if t is None:
            return None
        out, at = [], 0
        for a, b, k in all_spans(t, shared.value)[1]:
            if a >= at:
                out += [t[at:a], f"[{KINDS[k].upper()}]"]
            at = max(at, b)
        return "".join(out) + t[at:] if out else t

    return map_texts(docs, text, docs.columns, [(name, StringType())], lambda: lambda texts: [pa.array([clean(t) for t in texts], pa.string())])


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s.kind == kind)).cast("long")
