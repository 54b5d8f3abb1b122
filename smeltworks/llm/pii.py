"""Personal data: fixed base patterns, and candidates chosen by boosted trees.

Four base kinds are found by pattern and always stay. Wider generators propose further, overlapping spans: addresses with
the at sign or the dots spelled out, numbers with other separators or without a plus sign. Gradient-boosted trees judge
each by its format and its context, a logistic curve turns their score into a probability, and spans above a kind's
threshold are added, the most probable first, where they touch no span already chosen.

The trees learn from the corpus itself: base spans and rewritings of them (other separators, spelled-out signs) in
their real contexts are positive; base spans with broken digits or structure, harmless numbers in their place, and proposed spans
that fail a range, a check digit or a form are negative. Other proposed spans may be the very data to be found and get no label.
The sample is bounded.
"""

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltworks.llm import boosting
from smeltworks.llm.common import short_batches, with_columns

KINDS = ("email", "ip", "card", "phone")

# The base patterns. Those of addresses take in a whole run of characters even where no address follows it: the
# pattern as given would start anew at each of its characters, to no other result, in time quadratic in the run.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+)?")
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

AT = re.compile(r"@|[(\[{]\s?at\s?[)\]}]", re.IGNORECASE)
LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AFTER_AT = re.compile(r"\s?[A-Za-z0-9-]+(?:\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?[A-Za-z0-9-]+)+", re.IGNORECASE)
NUMBER = re.compile(r"[0-9][0-9\x20()./,:-]*[0-9]")
DOT = re.compile(r"\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?", re.IGNORECASE)
# No phone number is written so: with commas or colons, as a date, or as an amount.
HARMLESS = re.compile(r"[,:]|\b(?:19|20)[0-9]{2}([-./])[0-9]{1,2}\1[0-9]{1,2}\b|\b[0-9]{1,2}([-./])[0-9]{1,2}\2(?:19|20)[0-9]{2}\b")
# Bounds of the training sample, and the probability a span needs.
SAMPLE_DOCS = 20_000
SAMPLE_CANDIDATES = 20_000
THRESHOLD = {"email": 0.95, "ip": 0.97, "card": 0.97, "phone": 0.97}
# Fewer examples of either class teach nothing.
LEAST_EXAMPLES = 20

WORDS_FOR = (
    "mail e-mail email contact write reply address".split(),
    "ip host server node gateway dns address from".split(),
    "card visa credit pay payment account iban number".split(),
    "phone tel call fax mobile cell dial number".split(),
)
WORDS_AGAINST = "order invoice isbn issn version page pages figure table date year id ref sku part build line".split()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _is_byte(digits: str) -> bool:
    """Whether a number, however long, is at most 255."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind and start."""
    spans = []
    if "@" in text:
        spans += [(0, *m.span()) for m in EMAIL.finditer(text) if m[1]]
    spans += [(1, *m.span()) for m in IP.finditer(text) if m[1] and all(map(_is_byte, m[0].split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        spans += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return spans


def _local_part(text: str, at: int) -> int | None:
    """Where the name before an at sign at ``at``, with one blank between them at most, begins."""
    end = at - 1 if at and text[at - 1].isspace() else at
    start = end
    while start and text[start - 1] in LOCAL_SIGNS:
        start -= 1
    return start if start < end else None


def candidates(text: str) -> list[tuple[int, int, int]]:
    """High recall: overlapping proposals of all kinds, by position."""
    found = []
    for m in AT.finditer(text):
        start = _local_part(text, m.start())
        right = AFTER_AT.match(text, m.end()) if start is not None else None
        if right:
            found.append((0, start, right.end()))
    for m in NUMBER.finditer(text):
        start, end = m.span()
        if end - start < 7:
            continue
        n = len(digits_of(m[0]))
        if 7 <= n <= 15:
            while start and text[start - 1] in "+(" and m.start() - start < 2:
                start -= 1
            found.append((3, start, end))
        if 12 <= n <= 19:
            found.append((2, *m.span()))
        if 4 <= n <= 12 and len(re.findall(r"[.,:]", m[0])) == 3:
            found.append((1, *m.span()))
    return found


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    span, before, after = text[start:end], text[max(0, start - 60) : start], text[end : end + 30]
    digits = digits_of(span)
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    words = re.findall(r"[^\W\d_][\w-]*", before.lower())[-4:]
    near = words + re.findall(r"[^\W\d_][\w-]*", after.lower())[:2]
    parts = re.split(r"[.,:]", span)
    labels = re.split(r"\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?", span.lower())
    at = AT.search(span)
    return [
        kind,
        len(span),
        len(digits),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        groups[-1] if groups else 0,
        len(set(digits)),
        float(luhn(digits)) if digits else 0.0,
        *(span.count(c) for c in " ./,:-"),
        float("(" in span) - 2 * float(span.count("(") != span.count(")")),
        float(span.startswith(("+", "(+"))),
        float(len(parts) == 4 and all(p.isdigit() and _is_byte(p) for p in parts)),
        float("@" in span),
        float(at is not None),
        len(labels[-1]) if at else 0,
        float(labels[-1].isalpha()) if at else 0.0,
        float(any(c.isdigit() for c in span[: at.start()])) if at else 0.0,
        float(before[-1:].isalnum() or before[-1:] in ("_", "-", ".", "/")),
        float(after[:1].isalnum() or after[:1] in ("_", "-", "/", "@")),
        float(before[-1:] == "\n" or not before),
        sum(w in WORDS_FOR[kind] for w in near),
        sum(w in WORDS_AGAINST for w in near),
        sum(c.isdigit() for c in before) / (len(before) + 1),
    ]


def _rewritten(kind: int, span: str, rng: random.Random) -> str:
    """The same personal data in another dress."""
    if kind == 0:
        local, domain = span.split("@", 1)
        return local + rng.choice([" (at) ", "[at]", " [at] ", "(at)", "@"]) + domain.replace(".", rng.choice([" (dot) ", "[dot]", "."]))
    digits = digits_of(span)
    if kind == 1:
        return span
    if kind == 2:
        gap = rng.choice([".", "/", " ", "-"])
        return gap.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    gap = rng.choice([" ", "-", ".", "/"])
    head, tail = digits[:-7], digits[-7:]
    return rng.choice(["", "(", "+"]) + head + (") " if rng.random() < 0.3 else gap) + tail[:3] + gap + tail[3:]


def _broken(kind: int, span: str, rng: random.Random) -> str:
    """Something that only looks like it."""
    if kind == 0:
        return span.split("@", 1)[0] + "@" + rng.choice(["1.0", "v2.1", "0.5", "3.x9"])
    if kind == 1:
        return ".".join(str(rng.randint(256, 999)) if rng.random() < 0.6 else p for p in span.split(".")[:3]) + f".{rng.randint(256, 9999)}"
    digits = [rng.choice("0123456789") for _ in digits_of(span)]
    if kind == 2:
        digits = digits[: rng.randint(12, len(digits))]
        if luhn("".join(digits)):
            digits[-1] = str((int(digits[-1]) + 1) % 10)
        return "".join(digits)
    first, second = rng.randint(1, 4), rng.randint(4, 9)
    return rng.choice([".", "/", ",", ":"]).join(x for x in ("".join(digits[:first]), "".join(digits[first:second]), "".join(digits[second:])) if x)


def _harmless(rng: random.Random) -> str:
    """A number that is nobody's: a date, a time, an amount, a version, a list, a code."""
    n = rng.randint
    return rng.choice(
        [
            f"{n(1900, 2099)}-{n(1, 12):02}-{n(1, 28):02}",
            f"{n(1900, 2099)}-{n(1, 12):02}-{n(1, 28):02} {n(0, 23):02}:{n(0, 59):02}:{n(0, 59):02}",
            f"{n(1, 28):02}{(c := rng.choice('./-'))}{n(1, 12):02}{c}{n(1900, 2099)} {n(0, 23)}:{n(0, 59):02}",
            f"{n(1, 999)},{n(0, 999):03},{n(0, 999):03}.{n(0, 99):02}",
            f"{n(1, 999)}.{n(0, 999):03}.{n(0, 999):03},{n(0, 99):02}",
            f"{n(0, 9)}.{n(0, 99)}.{n(0, 9)}.{n(1000, 99999)}",
            rng.choice([", ", ",", " ", "-", ":", "/"]).join(str(n(0, 99)) for _ in range(n(4, 8))),
            f"{n(978, 979)}-{n(0, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}",
            f"{n(1, 9999)}-{n(1, 9999)}/{n(1, 9999)}",
            "".join(str(n(0, 9)) for _ in range(n(7, 19))),
        ]
    )


def _fails(kind: int, span: str) -> bool:
    """Whether a proposed span cannot be personal data of its kind: by its range, check digit or form. All others stay unlabelled."""
    if kind == 0:
        return any(c.isdigit() for c in DOT.split(span)[-1])
    if kind == 1:
        return any(not p.strip().isdigit() or not _is_byte(p.strip()) for p in re.split(r"[.,:]", span))
    if kind == 2:
        return not luhn(digits_of(span))
    return HARMLESS.search(span) is not None


def examples(text: str, seed: int) -> list[tuple[float, list[float]]]:
    """Labelled feature rows of one document."""
    rng, base = random.Random(seed), base_spans(text)
    rows, covered = [], Covered(len(text), base)
    for kind, start, end in candidates(text):
        if not covered.touches(start, end) and _fails(kind, text[start:end]):
            rows.append((0.0, features(text, kind, start, end)))
    for kind, start, end in base:
        rows.append((1.0, features(text, kind, start, end)))
        for label, span in (
            (1.0, _rewritten(kind, text[start:end], rng)),
            (0.0, _broken(kind, text[start:end], rng)),
            (0.0, _harmless(rng)),
            (0.0, _harmless(rng)),
        ):
            changed = text[max(0, start - 80) : start] + span + text[end : end + 80]
            at = min(start, 80)
            for k, s, e in candidates(changed):
                if s <= at + 1 and e >= at + len(span) - 1 and not (label and k != kind):
                    # A run of digits may pass the check digit by chance; that is no ground to call it harmless.
                    if label or (k, s, e) not in base_spans(changed):
                        rows.append((label, features(changed, k, s, e)))
    return rows


@dataclass(frozen=True)
class Selector:
    trees: boosting.Boosted
    slope: float
    offset: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.score(x) + self.offset, -50, 50)))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_candidates: int = SAMPLE_CANDIDATES) -> Selector | None:
    """Fit on a bounded sample of documents with a digit or an at sign; None if it holds too little to learn from."""
    holds = F.col(text).rlike("[0-9@]")
    source = docs.select(F.xxhash64(F.col(doc_id).cast("string")).alias("h"), F.col(text).alias("text")).where(holds)
    share = min(1.0, sample_docs / max(1, docs.count()))
    drawn = source.where(F.pmod("h", F.lit(1 << 30)) < int(share * (1 << 30)) + 1)

    def run(batches):
        for batch in batches:
            rows = [(h, i, *r) for h, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for i, r in enumerate(examples(t, h))]
            if rows:
                columns = zip(*rows, strict=True)
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["h", "i", "y", "x"])

    short_batches(docs.sparkSession)
    rows = drawn.mapInArrow(run, "h bigint, i bigint, y double, x array<double>")
    got = rows.orderBy(F.xxhash64("h", "i"), "y").limit(sample_candidates).toArrow()
    y = got["y"].to_numpy()
    if min(y.sum(), len(y) - y.sum()) < LEAST_EXAMPLES:
        return None
    x = np.array(got["x"].to_pylist())
    fold = np.arange(len(y)) % 4 == 0
    trees = boosting.fit(x[~fold], y[~fold])
    return Selector(trees, *boosting.calibrate(trees.score(x[fold]), y[fold]))


class Covered:
    """Which characters of a text lie in a chosen span."""

    def __init__(self, length: int, spans: list[tuple[int, int, int]]):
        self.marks = bytearray(length)
        for _, start, end in spans:
            self.add(start, end)

    def add(self, start: int, end: int) -> None:
        self.marks[start:end] = b"\1" * (end - start)

    def touches(self, start: int, end: int) -> bool:
        return self.marks.find(1, start, end) >= 0


def select(proposed: list[tuple[int, int, int]], p: np.ndarray, covered: Covered) -> list[tuple[int, int, int]]:
    """Proposals above their threshold that touch no chosen span, the most probable first."""
    chosen = []
    for i in np.argsort(-p, kind="stable").tolist():
        kind, start, end = proposed[i]
        if p[i] >= THRESHOLD[KINDS[kind]] and not covered.touches(start, end):
            covered.add(start, end)
            chosen.append((kind, start, end))
    return chosen


def find_spans(texts: list[str | None], selector: Selector | None) -> list[list[tuple[int, int, int, bool]]]:
    """Per text ``(kind, start, end, is_base)`` by kind and start."""
    base, proposed, rows = [], [], []
    for text in texts:
        text = text or ""
        base.append(base_spans(text))
        spans = candidates(text) if selector is not None else []
        covered = Covered(len(text), base[-1]) if spans else None
        spans = [c for c in spans if not covered.touches(c[1], c[2])]
        rows += [features(text, *c) for c in spans]
        proposed.append((spans, covered))
    p = selector.probability(np.array(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for sure, (spans, covered) in zip(base, proposed, strict=True):
        added = select(spans, p[at : at + len(spans)], covered) if spans else []
        at += len(spans)
        out.append(sorted([(*s, True) for s in sure] + [(*s, False) for s in added]))
    return out


def personal_spans(docs: DataFrame, selector: Selector | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``pii``: all spans as ``(kind, start, end, base)`` in code points, by kind and start.

    Null and empty texts have none. The time a text takes is in proportion to its length, whatever runs of digits or letters it holds. An input column named ``pii`` is replaced. Equal texts get equal spans.
    """

    def compute(texts: list) -> list:
        return [[[(KINDS[k], s, e, b) for k, s, e, b in spans] for spans in find_spans(texts, selector)]]

    return with_columns(docs, text, "pii array<struct<kind: string, start: bigint, end: bigint, base: boolean>>", compute, keep)


def redact(docs: DataFrame, selector: Selector | None, text: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind in brackets; null texts stay null, other columns stay."""

    def compute(texts: list) -> list:
        done = []
        for t, spans in zip(texts, find_spans(texts, selector), strict=True):
            parts, at = [], 0
            for start, end, kind in sorted((s, e, k) for k, s, e, _ in spans):
                if start >= at:
                    parts += [t[at:start], f"[{KINDS[kind].upper()}]"]
                    at = end
                elif end > at:  # spans of two kinds overlap: nothing of either is shown
                    at = end
            done.append(t if t is None else "".join([*parts, t[at:]]))
        return [done]

    return with_columns(docs, text, "_redacted string", compute).withColumn(text, F.col("_redacted")).select(*docs.columns)


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id``, base spans by kind, their digest, and all spans as text."""
    found = personal_spans(docs.select("doc_id", "text"), train(docs), keep=["doc_id"])
    base = F.filter("pii", lambda s: s["base"])
    counts = [_counted(base, k).alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("pii")).alias("spans"))
