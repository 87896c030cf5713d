"""Personal data by patterns, and by a semi-Markov conditional random field for other ways to write it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

KINDS = ("email", "ip", "card", "phone")
# The model is fitted on the words around at most so many texts, those with the smallest hashes of ids.
FIT_ROWS = 400
FIT_CHARACTERS = 200

Span = tuple[int, int, str]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """Whether the check digit of a number holds."""
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The spans of the four patterns, leftmost and non-overlapping per kind, by start then kind.

    Written so that no run of characters is read more than a few times, however long.
    """
    spans: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            spans.append((start, match.end(), "email"))
            free = match.end()
        else:
            free = at + 1
        at = text.find("@", free)
    for match in _NUMBERS.finditer(text):
        ends = [match.start() - 1]
        for part in match.group().split("."):
            ends.append(ends[-1] + 1 + len(part))
        parts = match.group().split(".")
        for first in range(0, len(parts) - 3, 4):
            if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in parts[first : first + 4]):
                spans.append((ends[first] + 1, ends[first + 4], "ip"))
    for match in _CARD.finditer(text):
        digits = _digits(match.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((*match.span(), "card"))
    for match in _PHONE.finditer(text):
        if 10 <= len(_digits(match.group())) <= 15:
            spans.append((*match.span(), "phone"))
    return _ordered(spans)


def _ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


# --- the field -------------------------------------------------------------------------------------

_TRIGGER = re.compile(r"[0-9@]|[\[({]\s*at\s*[\])}]|\bat\b(?=\s+\w+\s+dot\b)", re.I)
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|_")
_AT = re.compile(r"\s*[\[({]\s*at\s*[\])}]\s*|\s+at\s+|\s*@\s*", re.I)
_DOT = re.compile(r"\s*[\[({]\s*(?:dot|\.)\s*[\])}]\s*|\s+dot\s+|\.", re.I)
_CALL = re.compile(r"(?:tel|phone|call|mobile|cell|fax|telefon|tél|móvil|handy)\W*$", re.I)
_CODE = re.compile(r"(?:version|token|sha|id|isbn|no|nr|key|build|order)\W*$", re.I)
# A candidate has at most so many tokens: the segments of the field are bounded.
MAX_TOKENS = 24
MAX_GROUPS = 6  # of digits
_NEAR = 60


@dataclass(frozen=True)
class Candidate:
    """A segment that may be an entity: token numbers, characters, kind and features."""

    first: int
    last: int
    start: int
    end: int
    kind: int
    x: np.ndarray


_FEATURES = 22


def _describe(text: str, start: int, end: int, kind: int) -> np.ndarray | None:
    """The features of a whole span for a kind; None if it cannot be of that kind."""
    span = text[start:end]
    digits = _digits(span)
    left = text[start - 1 : start]
    right = text[end : end + 1]
    loose = any(c.isalnum() for c in (left, right) if c) or left in ("@", "#", "$", "=", "/") and bool(left)
    before = text[max(0, start - 14) : start]
    groups = re.findall(r"[0-9]+", span)
    between = re.split(r"[0-9]+", span)[1:-1]
    x = np.zeros(_FEATURES)
    x[0] = 1
    x[1] = loose
    x[2] = bool(_CALL.search(before))
    x[3] = bool(_CODE.search(before))
    x[4] = left in ("", " ", "\n", "\t", "(", "<", ":", '"', "'")
    x[5] = right in ("", " ", "\n", "\t", ")", ">", ",", ".", ";", '"', "'", "!", "?")
    if kind == 0:
        parts = _AT.split(span)
        if len(parts) != 2 or not parts[0] or not parts[1]:
            return None
        hosts = _DOT.split(parts[1])
        locals_ = _DOT.split(parts[0])
        if len(hosts) < 2 or not all(re.fullmatch(r"[A-Za-z0-9-]+", h) for h in hosts):
            return None
        if not all(re.fullmatch(r"[A-Za-z0-9_%+-]+", p) for p in locals_):
            return None
        x[6] = re.fullmatch(r"[A-Za-z]{2,10}", hosts[-1]) is not None
        x[7] = hosts[-1].lower() in ("com", "org", "net", "edu", "de", "fr", "es", "io", "info")
        x[8] = bool(re.search(r"[\[({]", span))
        x[9] = "@" in span
        x[10] = bool(re.search(r"\sdot\s", span, re.I))
        x[11] = len(_DOT.findall(right + text[end + 1 : end + 6])) > 0 and bool(re.match(r"(?:\s+dot\s+|\.\w)", text[end : end + 6], re.I))
        return x
    if kind == 1:
        if len(groups) != 4 or len(span) > 40 or not all(int(g) <= 255 for g in (g[:6] for g in groups)):
            return None
        if not all(re.fullmatch(r"\.|\s*[\[({]\s*(?:\.|dot)\s*[\])}]\s*|\s+dot\s+", b, re.I) for b in between):
            return None
        if not (span[0].isdigit() and span[-1].isdigit()):
            return None
        x[6] = len(set(between)) == 1
        x[7] = any(len(g) > 1 and g[0] == "0" for g in groups)
        x[8] = bool(re.search(r"[\[({]", span))
        return x
    if not re.fullmatch(r"[0-9+(][0-9\s()./+-]*[0-9]", span):
        return None
    same = len(set(between)) <= 1
    if kind == 2:
        if not 14 <= len(digits) <= 19 or not span[0].isdigit():
            return None
        x[6] = luhn(digits)
        x[7] = [len(g) for g in groups] == [4, 4, 4, 4]
        x[8] = same
        x[9] = len(groups) == 1
        x[10] = any("\n" in b for b in between)
        return x
    if not 9 <= len(digits) <= 15:
        return None
    sizes = [len(g) for g in groups]
    x[6] = span[0] == "+"
    x[7] = sizes[-2:] == [3, 4] and len(sizes) >= 3
    x[8] = len(sizes) >= 3 and sizes[-3] == 3
    x[9] = "(" in span and span.count("(") == span.count(")")
    x[10] = span.count("(") != span.count(")")
    x[11] = len(groups) == 1
    x[12] = digits.startswith("00") and sizes[0] in (2, 3, 4)
    x[13] = any("\n" in b for b in between)
    x[14] = all(b in ("-", " ", ".", ") ", ")", "/") for b in between)
    x[15] = len(digits) in (10, 11)
    x[16] = len(sizes) == 3 and sizes in ([4, 2, 2], [2, 2, 4])
    x[17] = any(b.strip() == "." for b in between)
    x[18] = bool(re.match(r"\s?[-./]?[0-9(]", text[end : end + 3]))
    x[19] = bool(re.search(r"[0-9)+(][-. ]?$", before))
    x[20] = same
    x[21] = max(sizes) > 5
    return x


def candidates(text: str, start: int, end: int) -> tuple[int, list[Candidate]]:
    """The number of tokens between two characters, and the segments of them that may be entities."""
    tokens = [m.span() for m in _TOKEN.finditer(text, start, end)]
    found = []
    for first, (i, after) in enumerate(tokens):
        opener = text[i]
        number = "0" <= opener <= "9" or opener in "+("
        word = opener.isascii() and opener.isalnum()
        if not number and not word:
            continue
        digits = ats = groups = 0
        for last in range(first, min(first + MAX_TOKENS, len(tokens))):
            begin, j = tokens[last]
            if last > first and begin - tokens[last - 1][1] > 2:
                break
            closer = text[j - 1]
            numeric = "0" <= closer <= "9"
            letters = not numeric and closer.isalpha()
            digits += (j - begin) * numeric
            groups += numeric
            ats += text[begin:j] in ("@", "at", "At", "AT")
            if digits > 19 or ats > 1 or groups > MAX_GROUPS and not word:
                break
            kinds = []
            if word and letters and ats == 1 and last - first >= 4 and closer.isascii():
                kinds = [0]
            elif number and numeric and groups <= MAX_GROUPS:
                kinds = [1] * (4 <= digits <= 12 and last - first >= 6)
                kinds += [2] * (digits >= 14) + [3] * (9 <= digits <= 15)
            for kind in kinds:
                x = _describe(text, i, j, kind)
                if x is not None:
                    found.append(Candidate(first, last, i, j, kind, x))
    return len(tokens), found


@dataclass(frozen=True)
class Field:
    """Weights of the features of a whole span, one row per kind; a token outside has score zero."""

    weights: np.ndarray

    def best(self, tokens: int, segments: list[Candidate]) -> list[Candidate]:
        """The segmentation of highest score: boundaries and kinds are chosen together."""
        ending: dict[int, list[tuple[float, Candidate]]] = {}
        for c in segments:
            ending.setdefault(c.last, []).append((float(self.weights[c.kind] @ c.x), c))
        value, back = [0.0] * (tokens + 1), [None] * (tokens + 1)
        for at in range(tokens):
            value[at + 1] = value[at]
            for score, c in ending.get(at, ()):
                if value[c.first] + score > value[at + 1]:
                    value[at + 1], back[at + 1] = value[c.first] + score, c
        chosen, at = [], tokens
        while at:
            c = back[at]
            if c is None:
                at -= 1
            else:
                chosen.append(c)
                at = c.first
        return chosen[::-1]


def fit(
    examples: list[tuple[int, list[Candidate], set[tuple[int, int, int]]]],
    epochs: int = 60,
    rate: float = 0.3,
    decay: float = 2e-4,
) -> Field:
    """Maximise the likelihood of the true segments (start, end, kind) over all segmentations."""
    weights = np.zeros((len(KINDS), _FEATURES))
    weights[:, 0] = -1
    total = np.full_like(weights, 1e-6)
    for _ in range(epochs):
        slope = np.zeros_like(weights)
        for tokens, segments, truth in examples:
            scores = [float(weights[c.kind] @ c.x) for c in segments]
            for c, p in zip(segments, _marginals(tokens, segments, scores)):
                slope[c.kind] += (((c.start, c.end, c.kind) in truth) - p) * c.x
        slope = slope / max(len(examples), 1) - decay * weights
        total += slope * slope
        weights = weights + rate * slope / np.sqrt(total)
    return Field(weights)


def _marginals(tokens: int, segments: list[Candidate], scores: list[float]) -> list[float]:
    """The probability of each segment, by the forward and backward sums of the field."""
    ending: dict[int, list[int]] = {}
    starting: dict[int, list[int]] = {}
    for n, c in enumerate(segments):
        ending.setdefault(c.last, []).append(n)
        starting.setdefault(c.first, []).append(n)
    forward = np.zeros(tokens + 1)
    for at in range(tokens):
        ways = [forward[at]] + [forward[segments[n].first] + scores[n] for n in ending.get(at, ())]
        forward[at + 1] = ways[0] if len(ways) == 1 else np.logaddexp.reduce(ways)
    backward = np.zeros(tokens + 1)
    for at in range(tokens - 1, -1, -1):
        ways = [backward[at + 1]] + [backward[segments[n].last + 1] + scores[n] for n in starting.get(at, ())]
        backward[at] = ways[0] if len(ways) == 1 else np.logaddexp.reduce(ways)
    return [
        float(np.exp(forward[c.first] + s + backward[c.last + 1] - forward[tokens]))
        for c, s in zip(segments, scores)
    ]


def lessons(contexts: list[str], seed: int = 11) -> list[tuple[int, list[Candidate], set]]:
    """Examples to learn from: entities and look-alikes, written in many ways, among given words."""
    rng = np.random.default_rng(seed)
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    pick = lambda *options: options[int(rng.integers(len(options)))]

    def card(valid: bool) -> str:
        digits = pick("4", "5") + number(14)
        last = next(d for d in "0123456789" if luhn(digits + d) == valid)
        groups = re.findall("....", digits + last)
        return pick("", " ", "-", ".", "  ", "/").join(groups)

    def name() -> str:
        return "".join(chr(97 + i) for i in rng.integers(0, 26, int(rng.integers(2, 8))))

    def entity(kind: int) -> str:
        if kind == 0:
            at = pick("@", " at ", " [at] ", "(at)", " @ ", "[at]", " (at) ")
            dot = pick(".", " dot ", "[dot]", "(dot)", " [dot] ") if at != " at " else " dot "
            local = name() + pick("", "." + name(), "." + number(2), "_" + name())
            return local + at + pick("", name() + dot) + name() + number(int(rng.integers(2))) + dot + pick("com", "org", "net", "de")
        if kind == 1:
            return pick("[.]", "(.)", " dot ", ".", "[dot]").join(str(i) for i in rng.integers(1, 256, 4))
        if kind == 2:
            return card(True)
        a, b, c = number(3), number(3), number(4)
        return pick(
            f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"{a} {b} {c}",
            f"+1 ({a}) {b}-{c}", f"00{number(2)} {number(2)} {number(7)}", f"+{number(2)}/{number(3)}/{number(6)}",
        )

    def lookalike() -> str:
        return pick(
            card(False), number(16), number(10), number(int(rng.integers(1, 20))), f"20{number(2)}-0{number(1)}-1{number(1)}",
            f"{number(2)}.{number(2)}.{number(4)}", f"version {number(1)}.{number(1)}.{number(1)}", f"{name()} at {name()}",
            f"{number(3)}.{number(3)}.{number(3)}.{number(3)}.{number(3)}", f"{number(1)},{number(3)}.{number(2)}",
            f"{number(2)}:{number(2)}", f"{number(4)} {number(4)}", f"{name()}@{name()}", f"@{name()}",
            f"{number(3)} {number(3)}", f"{number(13)}", f"{number(4)}-{number(4)}", f"{number(5)} {number(5)} {number(5)}",
        )

    examples = []
    for n in range(len(contexts) * 2):
        words = contexts[n % len(contexts)].split()
        kind = int(rng.integers(len(KINDS) + 3))
        inserted = entity(kind) if kind < len(KINDS) else lookalike()
        cue = pick("", "", "tel ", "call ") if kind == 3 else pick("", "", "no ")
        left = " ".join(words[:4]) + " " + cue
        text = left + inserted + pick(" ", ". ", ", ") + " ".join(words[4:8])
        tokens, segments = candidates(text, 0, len(text))
        truth = {(len(left), len(left) + len(inserted), kind)} if kind < len(KINDS) else set()
        if truth <= {(c.start, c.end, c.kind) for c in segments}:
            examples.append((tokens, segments, truth))
    return examples


def fit_on(docs: DataFrame, rows: int = FIT_ROWS) -> Field:
    """The field learnt among words of at most ``rows`` texts; without any, among none."""
    sample = (
        docs.where("text is not null")
        .select("doc_id", F.substring("text", 1, FIT_CHARACTERS).alias("words"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "words")
        .limit(rows)
        .toPandas()["words"]
    )
    contexts = [re.sub(r"[^\w\s]|[0-9_]", "", words) for words in sample]
    return fit(lessons((contexts + ["the word and"] * rows)[:rows]))


def added_spans(text: str, base: list[Span], field: Field) -> list[Span]:
    """The spans the field finds beside the base ones: none overlaps a base span.

    Only around characters that any entity has. Regions are as long as need be and end at a base span.
    """
    marks = [m.start() for m in _TRIGGER.finditer(text)]
    if not marks:
        return []
    regions: list[list[int]] = []
    for mark in marks:
        if regions and mark - _NEAR <= regions[-1][1]:
            regions[-1][1] = mark + _NEAR
        else:
            regions.append([mark - _NEAR, mark + _NEAR])
    taken: list[list[int]] = []
    for start, end, _ in base:
        if taken and start < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    found: list[Span] = []
    block = 0
    for low, high in regions:
        at, high = max(0, low), min(len(text), high)
        while block < len(taken) and taken[block][1] <= at:
            block += 1
        here = block
        while at < high:
            stop = min(high, taken[here][0]) if here < len(taken) else high
            if stop > at and _TRIGGER.search(text, at, stop):
                tokens, segments = candidates(text, at, stop)
                found += [(c.start, c.end, KINDS[c.kind]) for c in field.best(tokens, segments)]
            if here >= len(taken) or taken[here][0] >= high:
                break
            at = max(at, taken[here][1])
            here += 1
    return found


def find_spans(text: Column, field: Field) -> Column:
    """A struct per text: the ``base`` spans and ``all`` spans, each an array of kind, start and end.

    Ends are exclusive, places are code points. Null and empty texts have no spans.
    """

    @pandas_udf(
        "base array<struct<kind:string,start:long,end:long>>, all array<struct<kind:string,start:long,end:long>>"
    )
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rows = lambda found: [{"kind": k, "start": i, "end": j} for i, j, k in found]
        for texts in batches:
            base, whole = [], []
            for text in texts:
                own = base_spans(text) if text else []
                base.append(rows(own))
                whole.append(rows(_ordered(own + added_spans(text, own, field))) if text else [])
            yield pd.DataFrame({"base": base, "all": whole})

    return spans.asNondeterministic()(text)


def joined(spans: list[Span]) -> str:
    """kind:start:end of each span, comma-joined."""
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def digest(spans: list[Span]) -> str:
    """Hex SHA-256 of ``joined``."""
    return sha256(joined(spans).encode()).hexdigest()
