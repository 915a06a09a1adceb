"""Personal data: fixed patterns, and a semi-Markov conditional random field beside them.

The patterns give the base spans; they always stay. What they leave is cut into windows (runs
of digits with separators; addresses spelled around an "at"), and in each window a semi-Markov
conditional random field weighs every segmentation into entities and outside atoms. Features
see a candidate segment as a whole: its digits, grouping, checksum, neighbours. Dynamic
programming over segments of bounded length chooses boundaries and types jointly. The field's
weights are trained here, by stochastic gradient ascent on the likelihood of generated windows.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm.common import table
from weftline.session import prepare

KINDS = ("email", "ip", "card", "phone")
#: The longest entity: atoms and characters.
MOST_ATOMS, MOST_CHARS = 24, 64
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches of the address pattern. The local part holds no "@", so each match is
    the run before an "@" (from the last match on) and the domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        # characters before this "@" can't be part of a later local part
        done = found.end() if found else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """The patterns' matches, leftmost and non-overlapping per kind; a match that fails its
    check is dropped and the search goes on behind it."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(DIGIT.findall(m[0])) <= 15]
    return sorted(out)


ATOM = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
NUMBERS = re.compile(r"[+(]?[0-9](?:[ \t().\[\]/-]{0,3}[0-9])*")
AT = re.compile(r"\s?[\[({<]at[\])}>]\s?|\sat\s|\s@\s", re.I)
SPOKEN = re.compile(r"[A-Za-z0-9-]+(?:\s?(?:[\[({<]dot[\])}>]|\.)\s?[A-Za-z0-9-]+|\sdot\s[A-Za-z0-9-]+)+", re.I)
LEFT = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOT = re.compile(r"\s?[\[({<]dot[\])}>]\s?|\sdot\s|\.", re.I)


def windows(text: str, taken: list[Span]) -> list[tuple[int, int]]:
    """Where entities may be that the base spans leave room for, in order, not overlapping."""
    found = [m.span() for m in NUMBERS.finditer(text) if m.end() - m.start() >= 7] if DIGIT.search(text) else []
    for m in AT.finditer(text):
        left = LEFT.search(text, max(0, m.start() - MOST_CHARS), m.start())
        right = SPOKEN.match(text, m.end(), min(len(text), m.end() + MOST_CHARS))
        if left and right:
            found.append((left.start(), right.end()))
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    free: list[tuple[int, int]] = []
    at = 0
    busy = sorted((a, b) for a, _, b in taken)
    for a, b in out:
        while at < len(busy) and busy[at][1] <= a:
            at += 1
        k = at
        while k < len(busy) and busy[k][0] < b:
            if busy[k][0] > a:
                free.append((a, busy[k][0]))
            a = max(a, busy[k][1])
            k += 1
        if a < b:
            free.append((a, b))
    return [(a, b) for a, b in free if b - a >= 7]


def features(kind: int, span: str, before: str, after: str) -> list[str]:
    """Names of what holds of a whole candidate segment of a kind."""
    out = [f"{kind}"]
    if before and (before.isalnum() or before in "_=\"'"):
        out.append(f"{kind} glued left")
    if after and (after.isalnum() or after in "_=\"'"):
        out.append(f"{kind} glued right")
    digits = "".join(c for c in span if c in "0123456789")
    groups = [len(g) for g in re.findall("[0-9]+", span)]
    letters = any(c.isalpha() for c in span)
    out += [f"{kind} letters {letters}", f"{kind} groups {min(len(groups), 7)}"]
    if not letters:
        out.append(f"{kind} seps {''.join(sorted(set(re.sub('[0-9]', '', span))))}")
    if kind == 0:
        at, dot = AT.findall(span), DOT.findall(AT.sub("@", span))
        out += [f"{kind} ats {min(len(at), 2)}", f"{kind} dots {bool(dot)}", f"{kind} form {bool(AT.search(span)) and bool(SPOKEN.fullmatch(AT.split(span)[-1]))}", f"{kind} marked {any(c in '[({<@' for c in span)}"]
    elif kind == 1:
        parts = re.split(r"\s?\[?\(?\.\)?\]?\s?", span)
        out += [f"{kind} four {len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)}"]
    elif kind == 2:
        out += [f"{kind} length {14 <= len(digits) <= 19}", f"{kind} luhn {luhn(digits)}", f"{kind} fours {len(groups) >= 4 and set(groups[:3]) == {4}}"]
    else:
        out += [f"{kind} n {min(len(digits), 16)}", f"{kind} shape {'-'.join(map(str, groups[:5]))}", f"{kind} opens {span[0] if span[0] in '+(' else '9'}", f"{kind} area {digits[-10:-9] not in ('', '0', '1')}"]
    return out


class Field:
    """A semi-Markov conditional random field over the atoms of a window."""

    def __init__(self) -> None:
        self.w: dict[str, float] = defaultdict(float)

    def segments(self, text: str, a: int, b: int) -> tuple[list[tuple[int, int]], list[list[tuple[int, int, list[str]]]]]:
        """The window's atoms, and for each atom the segments that end with it: (first atom, kind or
        -1 for outside, features)."""
        atoms = [m.span() for m in ATOM.finditer(text, a, b)]
        ends: list[list[tuple[int, int, list[str]]]] = []
        for j, (start_j, end) in enumerate(atoms):
            found = [(j, -1, ["outside"])]
            if text[end - 1].isalnum():
                for i in range(j, max(-1, j - MOST_ATOMS), -1):
                    start = atoms[i][0]
                    if end - start > MOST_CHARS:
                        break
                    if end - start < 7 or not (text[start].isalnum() or text[start] in "+("):
                        continue
                    span = text[start:end]
                    before, after = text[start - 1] if start else "", text[end] if end < len(text) else ""
                    has = any(c.isalpha() for c in span)
                    for kind in (0,) if has else (1, 2, 3):
                        if kind or AT.search(span):
                            found.append((i, kind, features(kind, span, before, after)))
            ends.append(found)
        return atoms, ends

    def score(self, names: list[str]) -> float:
        return sum(self.w[n] for n in names if n in self.w)

    def best(self, text: str, a: int, b: int) -> list[Span]:
        """The entities of the window's best segmentation."""
        atoms, ends = self.segments(text, a, b)
        value, back = [0.0], []
        for j, found in enumerate(ends):
            v, at = max((value[i] + self.score(names), n) for n, (i, _, names) in enumerate(found))
            value.append(v)
            back.append(found[at])
        out, j = [], len(atoms)
        while j:
            i, kind, _ = back[j - 1]
            if kind >= 0:
                out.append((atoms[i][0], kind, atoms[j - 1][1]))
            j = i
        return out[::-1]

    def learn(self, text: str, a: int, b: int, truth: list[Span], rate: float) -> None:
        """One step up the gradient of the log-likelihood: observed less expected features."""
        atoms, ends = self.segments(text, a, b)
        n = len(atoms)
        sums = [[self.score(names) for _, _, names in found] for found in ends]
        forward, backward = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]

        def add(x: float, y: float) -> float:
            hi, lo = max(x, y), min(x, y)
            return hi if lo == -math.inf else hi + math.log1p(math.exp(lo - hi))

        for j in range(n):
            for (i, _, _), s in zip(ends[j], sums[j], strict=True):
                forward[j + 1] = add(forward[j + 1], forward[i] + s)
        for j in range(n - 1, -1, -1):
            for (i, _, _), s in zip(ends[j], sums[j], strict=True):
                backward[i] = add(backward[i], backward[j + 1] + s)
        wanted = {(s, k, e) for s, k, e in truth}
        inside = {j for s, _, e in wanted for j, (x, y) in enumerate(atoms) if s <= x and y <= e}
        for j in range(n):
            for (i, kind, names), s in zip(ends[j], sums[j], strict=True):
                expected = math.exp(forward[i] + s + backward[j + 1] - forward[n])
                seen = (j not in inside) if kind < 0 else (atoms[i][0], kind, atoms[j][1]) in wanted
                if abs(seen - expected) > 1e-6:
                    for name in names:
                        self.w[name] += rate * (seen - expected)


def generated(rng: random.Random) -> tuple[str, list[Span]]:
    """One training window in some context, and its entities."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 8)))
    area = lambda: rng.choice("23456789") + d(2)
    part = lambda: str(rng.randrange(256))

    def card(sep: str) -> str:
        body = rng.choice("3456") + d(14)
        body += next(c for c in "0123456789" if luhn(body + c))
        return sep.join(body[i : i + 4] for i in range(0, 16, 4))

    kind = rng.choice([0, 1, 2, 3, 3, -1, -1, -1])
    if kind == 0:
        at, dot = rng.choice([(" [at] ", " [dot] "), ("(at)", "(dot)"), (" (at) ", "."), (" at ", " dot "), (" @ ", "."), ("[at]", ".")])
        core = f"{word()}{rng.choice(['', '.' + d(2), '_x'.replace('_', '.')])}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', word()])}"
    elif kind == 1:
        core = rng.choice(["[.]", "(.)", " . "]).join(part() for _ in range(4))
    elif kind == 2:
        core = card(rng.choice(["/", ".", "  "]))
    elif kind == 3:
        core = rng.choice([f"({area()}) {area()}-{d(4)}", f"{area()}-{area()}-{d(4)}", f"{area()}.{area()}.{d(4)}", f"1-{area()}-{area()}-{d(4)}", f"({area()}){area()}-{d(4)}"])
    else:
        core = rng.choice([
            d(rng.randrange(7, 20)), f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(4)}-{d(4)}", f"{word()} at {word()}. {word()}",
            f"{d(3)} {d(3)} {d(3)}", f"{d(1)}.{d(1)}.{d(2)}.{d(3)}.{d(1)}", f"{d(4)} {d(4)} {d(4)} {d(3)}", f"({d(4)}) {d(4)}", f"{d(2)}.{d(5)} {d(3)}", " ".join(d(rng.randrange(1, 6)) for _ in range(rng.randrange(4, 9))), f"a{d(9)}f", f"{d(12)}e", f"{d(8)}-{d(4)}-{d(4)}",
            f"{word()} at the {word()}.{word()}",
        ])
    left = rng.choice(["", f"{word()} ", f"{word()}, ", f"{word()}: ", f"{word()}\n"]) if kind >= 0 else rng.choice(["", f"{word()} ", f"{word()}=", f'{word()} = "', word()])
    text = left + core + rng.choice(["", f" {word()}", f", {word()}", ".", f"\n{word()}"])
    return text, [(len(left), kind, len(left) + len(core))] if kind >= 0 else []


@lru_cache(maxsize=1)
def trained(seed: int = 7, steps: int = 1500, rate: float = 0.3) -> Field:
    """The field trained on ``steps`` generated texts; the same in every process."""
    rng, field = random.Random(seed), Field()
    for n in range(steps):
        text, truth = generated(rng)
        for a, b in windows(text, base_spans(text)):
            own = [s for s in truth if a <= s[0] and s[2] <= b]
            if len(own) == len([s for s in truth if s[0] < b and a < s[2]]):
                field.learn(text, a, b, own, rate / (1 + 3 * n / steps))
    field.w = dict(field.w)
    return field


def find(text: str | None) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans) of a text, each by start, then kind. Null and empty texts have none."""
    text = text or ""
    base = base_spans(text)
    field, more = trained(), []
    for a, b in windows(text, base):
        more += field.best(text, a, b)
    return base, sorted(base + more)


def written(spans: list[Span]) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for a, k, b in spans])


def redact(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the union,
    under the kind of the first."""
    out, at = [], 0
    for a, k, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", with_redacted: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256,
    spans (all, as kind:start:end in code points, end exclusive) and, if asked for, redacted.

    Null texts count as empty. Whole texts are searched, whatever their length; only one entity's
    length is bounded. Rows that repeat are treated alike; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"] + ["redacted"] * with_redacted

    def run(batches):
        for b in batches:
            rows = []
            for t in b.column("t"):
                given = t.as_py() or ""
                base, spans = find(given)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
                rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans), *([redact(given, spans)] * with_redacted)))
            kinds = [pa.int64()] * 4 + [pa.string()] * (2 + with_redacted)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds))], names)

    kind = dict(docs.dtypes)[doc_id]
    schema = f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string" + ", redacted string" * with_redacted
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).mapInArrow(run, schema)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
