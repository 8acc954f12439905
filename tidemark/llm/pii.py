"""Personal data by fixed patterns and a semi-Markov conditional random field.

Four patterns give the base spans. A segment model is trained on them: features of
a whole candidate span (its shape, digit count, checksum, what stands beside it)
score every segment of up to a fixed number of units, and dynamic programming over
segments and types chooses boundaries and types together. Spans that it is almost
sure of, and that touch no base span, are added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_like, lean_batches, smallest_hashes

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns of the base spans.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d *= 1 + i % 2
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in text.split("."))


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, looked for only where an @ stands.

    A match starts where the run of local characters before its @ starts, or
    where the match before it ends; walking the @ signs finds the same spans as a
    search from every character, without trying each of them.
    """
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _EMAIL.match(text, start) if start < at else None
        if match:
            yield match.span()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """The spans that the patterns and checks accept, by kind, then start."""
    spans: list[Span] = [("email", *s) for s in _emails(text)]
    spans += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append(("phone", *m.span()))
    return spans


#: Runs of tokens that each hold a digit or an @: elsewhere nothing can be an entity.
_REGION = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+(?: [^\s0-9@]*+[0-9@]\S*+)*+")
_UNIT = re.compile(r"[A-Za-z]+|[0-9]+|.", re.S)
#: Units of the longest segment that can be an entity.
LONGEST = 16
#: Features are hashed to this many weights per kind.
WIDTH = 1 << 12
#: Bounds of the training sample: documents, and characters of a region taken from them.
SAMPLE_DOCS, SAMPLE_CHARS = 1200, 400
#: Regions trained on, and steps.
SAMPLE_REGIONS, STEPS = 1500, 40
#: Least posterior probability of a span that is added.
SURE = 0.95

_RUNS = (re.compile(r"[A-Za-z]+"), re.compile(r"[0-9]+"))


def _slot(feature: str) -> int:
    """A feature's weight, the same in every process."""
    return int.from_bytes(hashlib.blake2b(feature.encode(), digest_size=4).digest()) % WIDTH


def _kind_of(unit: str) -> str:
    if unit == "":
        return "edge"
    if unit.isdigit():
        return "digits"
    return "letters" if unit.isalpha() else unit


class Segmenter:
    """The candidate segments of a region and their features, with a memory for features."""

    def __init__(self) -> None:
        self.slots: dict[str, int] = {}

    def _slot(self, feature: str) -> int:
        if feature not in self.slots:
            if len(self.slots) > 100_000:
                self.slots.clear()
            self.slots[feature] = _slot(feature)
        return self.slots[feature]

    def units(self, region: str) -> list[tuple[int, int]]:
        return [m.span() for m in _UNIT.finditer(region)]

    def segments(
        self, region: str, units: list[tuple[int, int]]
    ) -> list[tuple[int, int, tuple[int, ...]]]:
        """(first unit, last unit + 1, feature slots) of all that could be an entity."""
        out = []
        texts = [region[a:b] for a, b in units]
        for i in range(len(units)):
            if texts[i].isspace():
                continue
            for j in range(i + 1, min(len(units), i + LONGEST) + 1):
                last = texts[j - 1]
                if not last[-1].isalnum():
                    continue
                span = region[units[i][0] : units[j - 1][1]]
                digits = sum(c.isdigit() for c in span)
                if digits < 4 and "@" not in span:
                    continue
                before = texts[i - 1] if i else ""
                after = texts[j] if j < len(units) else ""
                out.append((i, j, self._features(span, digits, before, after)))
        return out

    def _features(self, span: str, digits: int, before: str, after: str) -> tuple[int, ...]:
        shape = _RUNS[1].sub("9", _RUNS[0].sub("a", span))
        numbers = re.sub(r"[^0-9]", "", span)
        quads = span.count(".") == 3 and re.fullmatch(r"[0-9.]+", span) is not None
        names = (
            "bias",
            f"shape={shape}" if len(shape) <= 24 else "shape=long",
            f"digits={min(digits, 20)}",
            f"luhn={luhn(numbers) if 16 <= digits <= 19 else None}",
            f"octets={_IP.fullmatch(span) is not None and _octets(span) if quads else None}",
            f"at={span.count('@')}/{'.' in span.rpartition('@')[2]}",
            f"plus={span[0] == '+'}/{8 <= digits <= 15}",
            f"before={_kind_of(before)}",
            f"after={_kind_of(after)}",
            f"letters={any(c.isalpha() for c in span)}",
        )
        return tuple(self._slot(n) for n in names)


@dataclass
class SegmentModel:
    """Weights per kind and feature, and between the kinds of neighbouring segments.

    Kind 0 is a single unit outside any entity, with score 0; ``between[a, b]`` is
    the weight of kind b after kind a.
    """

    weights: np.ndarray
    between: np.ndarray

    def scores(self, segments: list[tuple[int, int, tuple[int, ...]]]) -> np.ndarray:
        if not segments:
            return np.zeros((0, len(KINDS)))
        slots = np.array([s[2] for s in segments], dtype=np.int64)
        return self.weights[:, slots].sum(axis=2).T  # segment by kind


def _log_sum(values: np.ndarray, axis: int = 0) -> np.ndarray:
    top = np.max(values, axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(values - top).sum(axis=axis)) + np.squeeze(top, axis=axis)


def _posterior(
    n: int, segments: list[tuple[int, int, tuple[int, ...]]], scores: np.ndarray, between: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Log of the normaliser, probability of each segment and kind, expected neighbours.

    Forward and backward sums over unit positions: at each, the kind of the segment
    that ends there. The longest segment bounds the work per unit.
    """
    k = len(KINDS) + 1
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    for s, (i, j, _) in enumerate(segments):
        by_end[j].append(s)
        by_start[i].append(s)
    ahead = np.full((n + 1, k), -np.inf)  # segments end here, last of kind
    ahead[0, 0] = 0.0
    enter = np.empty((n + 1, k))  # a segment of the kind starts here
    enter[0] = _log_sum(ahead[0][:, None] + between)
    for j in range(1, n + 1):
        ahead[j, 0] = enter[j - 1, 0]
        if by_end[j]:
            at = np.array([segments[s][0] for s in by_end[j]])
            ahead[j, 1:] = _log_sum(enter[at, 1:] + scores[by_end[j]])
        enter[j] = _log_sum(ahead[j][:, None] + between)
    back = np.zeros((n + 1, k))  # from here to the end, after a segment of the kind
    leave = np.full((n + 1, k), -np.inf)  # from here, starting with a segment of the kind
    for i in range(n - 1, -1, -1):
        leave[i, 0] = back[i + 1, 0]
        if by_start[i]:
            to = np.array([segments[s][1] for s in by_start[i]])
            leave[i, 1:] = _log_sum(back[to, 1:] + scores[by_start[i]])
        back[i] = _log_sum(between + leave[i][None, :], axis=1)
    total = float(_log_sum(ahead[n]))
    if segments:
        first = np.array([s[0] for s in segments])
        last = np.array([s[1] for s in segments])
        held = np.exp(np.minimum(enter[first, 1:] + scores + back[last, 1:] - total, 0.0))
    else:
        held = np.zeros((0, k - 1))
    pairs = ahead[:n, :, None] + between[None] + leave[:n, None, :] - total
    return total, held, np.exp(np.minimum(pairs, 0.0)).sum(axis=0)


def best_path(
    n: int, segments: list[tuple[int, int, tuple[int, ...]]], scores: np.ndarray, between: np.ndarray
) -> list[tuple[int, int]]:
    """(segment, kind from 1) of the entities on the best path through a region."""
    k = len(KINDS) + 1
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    for s, (_, j, _) in enumerate(segments):
        by_end[j].append(s)
    best = np.full((n + 1, k), -np.inf)
    best[0, 0] = 0.0
    came: list[list[tuple[int, int, int] | None]] = [[None] * k for _ in range(n + 1)]
    for j in range(1, n + 1):
        options = [(j - 1, 0, -1, 0.0)]
        options += [
            (segments[s][0], kind, s, scores[s, kind - 1]) for s in by_end[j] for kind in range(1, k)
        ]
        for i, kind, s, worth in options:
            reach = best[i] + between[:, kind]
            prior = int(reach.argmax())
            if reach[prior] + worth > best[j, kind]:
                best[j, kind] = reach[prior] + worth
                came[j][kind] = (i, prior, s)
    found, j, kind = [], n, int(best[n].argmax())
    while j:
        step = came[j][kind]
        if step is None:
            break
        if kind:
            found.append((step[2], kind))
        j, kind = step[0], step[1]
    return found[::-1]


def _regions(text: str) -> list[tuple[int, str]]:
    return [(m.start(), m[0]) for m in _REGION.finditer(text)]


def fit(samples: list[tuple[str, list[Span]]]) -> SegmentModel:
    """A model of regions with their base spans, by gradient ascent on the likelihood."""
    cutter = Segmenter()
    data = []
    for region, spans in samples:
        units = cutter.units(region)
        segments = cutter.segments(region, units)
        starts = {u[0]: i for i, u in enumerate(units)}
        ends = {u[1]: i + 1 for i, u in enumerate(units)}
        where = {(i, j): s for s, (i, j, _) in enumerate(segments)}
        gold, free = [], 0
        for kind, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
            s = where.get((starts.get(a, -1), ends.get(b, -1)))
            if s is not None and starts[a] >= free:
                gold.append((s, KINDS.index(kind) + 1))
                free = ends[b]
        data.append((len(units), segments, gold))
    k = len(KINDS)
    weights, between = np.zeros((k, WIDTH)), np.zeros((k + 1, k + 1))
    if not any(gold for _, _, gold in data):
        weights[:, _slot("bias")] = -50.0  # nothing to learn from: nothing is added
        return SegmentModel(weights, between)
    truth = np.zeros_like(weights)
    follow = np.zeros_like(between)
    for n, segments, gold in data:
        at, last = 0, 0
        for s, kind in gold:
            i, j, slots = segments[s]
            np.add.at(truth[kind - 1], list(slots), 1)
            for _ in range(i - at):
                follow[last, 0] += 1
                last = 0
            follow[last, kind] += 1
            at, last = j, kind
        for _ in range(n - at):
            follow[last, 0] += 1
            last = 0
    moments = [np.zeros_like(weights), np.zeros_like(weights),
               np.zeros_like(between), np.zeros_like(between)]
    flat = [np.array([s[2] for s in segments], dtype=np.int64) for _, segments, _ in data]
    for step in range(1, STEPS + 1):
        expected, pairs = np.zeros_like(weights), np.zeros_like(between)
        model = SegmentModel(weights, between)
        for (n, segments, _), slots in zip(data, flat, strict=True):
            _, held, near = _posterior(n, segments, model.scores(segments), between)
            pairs += near
            for kind in range(k):
                if len(segments):
                    np.add.at(expected[kind], slots.ravel(), np.repeat(held[:, kind], slots.shape[1]))
        grads = (truth - expected - 0.02 * weights, follow - pairs - 0.02 * between)
        for i, (grad, value) in enumerate(zip(grads, (weights, between), strict=True)):
            moments[2 * i] = 0.9 * moments[2 * i] + 0.1 * grad
            moments[2 * i + 1] = 0.98 * moments[2 * i + 1] + 0.02 * grad**2
            speed = np.sqrt(moments[2 * i + 1] / (1 - 0.98**step)) + 1e-8
            value += 0.3 * moments[2 * i] / (1 - 0.9**step) / speed
    return SegmentModel(weights, between)


def train(docs: DataFrame) -> SegmentModel:
    """A model from the regions of a bounded sample of documents.

    The sample are the SAMPLE_DOCS texts with digits or an @ whose hashes are the
    smallest; of their regions up to SAMPLE_CHARS long, those with base spans come
    first, SAMPLE_REGIONS in all. Only those regions come to the driver.
    """
    eligible = docs.select("text", F.xxhash64("text").alias("h")).where(
        F.col("text").rlike("[0-9@]")
    )
    picked = smallest_hashes(eligible, "h", SAMPLE_DOCS)

    def regions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text, h in zip(batch["text"], batch["h"], strict=True):
                spans = base_spans(text)
                for start, region in _regions(text):
                    if len(region) > SAMPLE_CHARS:
                        continue
                    end = start + len(region)
                    inside = [(k, a - start, b - start) for k, a, b in spans if start <= a and b <= end]
                    rows.append((region, ",".join(f"{k}:{a}:{b}" for k, a, b in inside), h))
            yield pd.DataFrame(rows, columns=["region", "spans", "h"])

    rows = (
        picked.mapInPandas(regions, "region string, spans string, h long")
        .distinct()
        .orderBy(F.col("spans") == "", F.xxhash64("region"), "h", "spans")
        .limit(SAMPLE_REGIONS)
        .collect()
    )

    def parsed(spans: str) -> list[Span]:
        parts = (s.split(":") for s in spans.split(",") if s)
        return [(k, int(a), int(b)) for k, a, b in parts]

    return fit([(r["region"], parsed(r["spans"])) for r in rows])


def added_spans(text: str, base: list[Span], model: SegmentModel, cutter: Segmenter) -> list[Span]:
    """Spans of the best paths that are almost sure and touch no base span."""
    out: list[Span] = []
    for start, region in _regions(text):
        units = cutter.units(region)
        segments = cutter.segments(region, units)
        if not segments:
            continue
        scores = model.scores(segments)
        if scores.max() + model.between.max() * 2 <= 0:
            continue  # no entity can be on the best path
        path = best_path(len(units), segments, scores, model.between)
        taken = []
        for s, kind in path:
            i, j, _ = segments[s]
            a, b = start + units[i][0], start + units[j - 1][1]
            if all(b <= x or y <= a for _, x, y in base):
                taken.append((s, kind, a, b))
        if taken:
            _, held, _ = _posterior(len(units), segments, scores, model.between)
            out += [(KINDS[k - 1], a, b) for s, k, a, b in taken if held[s, k - 1] >= SURE]
    return out


def joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in ordered)


def find_pii(docs: DataFrame, model: SegmentModel | None = None) -> DataFrame:
    """``docs`` with base_spans and spans: kind:start:end, comma-joined, by kind, then start.

    Starts and ends are code points of the whole text, ends exclusive. ``spans``
    are the base spans and those the model adds. NULL and empty texts have none,
    and both columns are empty strings. Names that clash with columns of ``docs``
    get an underscore.
    """
    lean_batches(docs.sparkSession)
    trained = model or train(docs)

    @F.pandas_udf("base string, every string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cutter = Segmenter()
        for texts in batches:
            rows = []
            for text in texts:
                base = base_spans(text) if text else []
                more = added_spans(text, base, trained, cutter) if text else []
                rows.append((joined(base), joined(base + more)))
            yield pd.DataFrame(rows, columns=["base", "every"])

    hit = column_like("found", docs.columns)
    base, every = (column_like(n, docs.columns) for n in ("base_spans", "spans"))
    return docs.withColumn(hit, found("text")).select(
        *docs.columns, F.col(f"{hit}.base").alias(base), F.col(f"{hit}.every").alias(every)
    )
