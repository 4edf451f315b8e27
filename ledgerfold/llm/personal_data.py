"""Personal data: fixed patterns, and a semi-Markov conditional random field for what they miss.

The patterns (``base_spans``) find e-mail addresses, IP addresses, card numbers and phone numbers in their usual form.
The field adds other written forms of the four kinds (``name (at) host dot com``, ``1[.]2[.]3[.]4``, cards with dots,
phone numbers without a plus): candidate segments of bounded length are scored whole, by features of the
segment (digit groups, separators, checksums, words before it, what it is glued to), and a dynamic
program over the candidates chooses boundaries and kinds jointly, with a weight for segments that follow each
other directly.  Segments that touch a span of the patterns are no candidates: those spans stay.

``fit`` trains the weights by the exact conditional likelihood (forward and backward sums over all
segmentations) on windows of at most ``SAMPLE`` different texts of the corpus, into which written forms of each kind
and numbers that are none are put.  The field is a table of some hundred numbers.  ``find`` scans every text whole, in Arrow
batches; none is passed over (``name (at) host.com`` has no digit, no ``@`` and no ``dot``).

Defined results: a null or empty text has no span; spans of different kinds may overlap among the patterns' own;
repeated rows give repeated rows; an empty table gives none (and ``fit`` then learns from the written forms
alone); extra columns are not read; texts are never cut.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Texts that windows are taken from, code points of a window, written forms put into windows, passes of the training.
SAMPLE, WINDOW, FORMS, PASSES = 400, 300, 1_600, 60
#: What a segment must score to be worth a span (log odds), and the training's L2 weight.
MARGIN, L2 = 2.0, 0.02
#: Digit groups of a candidate number, labels of a candidate host, at most; code points before it in which cue words count.
GROUPS, LABELS, BEFORE = 8, 6, 24

#: Fixed values of the task: the four patterns, digits of a card and of a phone number.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)

#: Words that announce a kind, and frequent last labels of hosts.
CUES = {"email": "mail email e-mail contact write kontakt correo courriel", "ip": "ip host server address addr adresse client",
        "card": "card visa mastercard credit cc karte carte tarjeta", "phone": "tel phone call fax mobile telefon cell handy tél téléphone teléfono"}
CUE = {word: kind for kind, words in CUES.items() for word in words.split()}
TOP = set("com org net edu gov info io de fr es uk eu it ch at nl".split())

RESULT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
Span = tuple[int, str, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2]))


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by start and kind.  Every pattern is matched in time linear in the text."""
    out: list[Span] = []
    at, last = text.find("@"), 0
    while at >= 0:  # the leftmost match for an @ starts where its run of local characters does
        start = at
        while start > last and LOCAL.match(text, start - 1):
            start -= 1
        host = HOST.match(text, at) if start < at else None
        last = host.end() if host else at + 1
        if host:
            out.append((start, "email", last))
        at = text.find("@", last)
    out += [(m.start(), "ip", m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x[-4:]) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = digits_of(m[0]) if len(m[0]) < 2 * CARD_DIGITS[1] else ""
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            out.append((m.start(), "card", m.end()))
    out += [(m.start(), "phone", m.end()) for m in PHONE.finditer(text) if PHONE_DIGITS[0] <= len(digits_of(m[0])) <= PHONE_DIGITS[1]]
    return in_order(out)


# candidate segments and their features

NUMBERS = re.compile(r"[0-9](?:[0-9()\[\]{}./+_ -]*[0-9])?")
GROUP = re.compile("[0-9]+")
AT = re.compile(r" ?@ ?| ?[(\[{<] ?at ?[)\]}>] ?| at ", re.IGNORECASE)
DOT = re.compile(r" ?[(\[{<] ?(?:dot|\.) ?[)\]}>] ?| ?\. ?| dot ", re.IGNORECASE)
LABEL = re.compile(r"[A-Za-z0-9-]{1,63}(?![A-Za-z0-9-])")
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    kind: str
    features: tuple[str, ...]


def _cues(text: str, start: int) -> list[str]:
    return sorted({f"cue {CUE[w]}" for w in (x.lower() for x in WORD.findall(text[max(0, start - BEFORE):start])) if w in CUE})


def _sign(mark: str) -> str:
    """How a separator or a mark is written."""
    return re.sub("[A-Za-z]+", "a", re.sub(" +", " ", mark))


def _emails(text: str) -> Iterator[Candidate]:
    for mark in AT.finditer(text):
        start = mark.start()
        while start and mark.start() - start < 64 and LOCAL.match(text, start - 1):
            start -= 1
        if start == mark.start() or start and LOCAL.match(text, start - 1):
            continue
        local = text[start:mark.start()]
        common = ["bias", f"at {_sign(mark[0])}", f"local {min(3, len(local) // 3)}", "local dot" if "." in local else "local plain", *_cues(text, start)]
        label, dots, at = LABEL.match(text, mark.end()), set(), 0
        for n in range(1, LABELS):
            dot = DOT.match(text, label.end()) if label else None
            label = LABEL.match(text, dot.end()) if dot else None
            if not label:
                break
            dots.add(_sign(dot[0]))
            more = DOT.match(text, label.end())
            more = bool(more and LABEL.match(text, more.end()))
            at = label.end()
            top = label[0].lower()
            yield Candidate(start, at, "email", (*common, f"labels {n}", f"dots {' or '.join(sorted(dots))}", f"form {_sign(mark[0])}{'|'.join(sorted(dots))}", "top known" if top in TOP else "top other",
                                                 f"top {'digits' if not top.isalpha() else min(len(top), 5)}", "more" if more else "last"))


def _numbers(text: str) -> Iterator[Candidate]:
    for island in NUMBERS.finditer(text):
        groups = [(m.start() + island.start(), m.end() + island.start()) for m in GROUP.finditer(island[0])]
        for i in range(len(groups)):
            total = 0
            for j in range(i, min(len(groups), i + GROUPS)):
                a, b = groups[i][0], groups[j][1]
                total += groups[j][1] - groups[j][0]
                if total > CARD_DIGITS[1]:
                    break
                four = j - i == 3 and total <= 12
                if total < 7 and not four:
                    continue
                parts = [text[x:y] for x, y in groups[i:j + 1]]
                seps = [text[groups[k][1]:groups[k + 1][0]] for k in range(i, j)]
                opened = a > 0 and text[a - 1] == "(" and any(")" in s for s in seps)
                start = a - opened
                signs = sorted({_sign(s) for s in seps})
                octets = four and all(int(x) <= 255 for x in parts)
                digits = "".join(parts)
                glued = (text[start - 1] if start else " "), (text[b] if b < len(text) else " ")
                f = ["bias", f"digits {total}", f"groups {j - i + 1}", f"lengths {' '.join(str(len(x)) for x in parts)}", f"signs {'|'.join(signs)}" if signs else "one group",
                     "one sign" if len(signs) == 1 else "mixed signs", "octets" if octets else "no octets", *_cues(text, start)]
                f += ["opened"] * opened + ["zero first"] * (digits[0] == "0") + ["zeros first"] * (digits[:2] == "00") + ["a year"] * any(len(x) == 4 and x[:2] in ("19", "20") for x in parts)
                f += ["glued before"] * (glued[0].isalnum() or glued[0] in ".,$€£/:_#=\"'") + ["glued behind"] * (glued[1].isalnum() or glued[1] in "%€$:/_\"'")
                f += ["digits before"] * (i > 0) + ["digits behind"] * (j + 1 < len(groups))
                if octets and signs:
                    yield Candidate(start, b, "ip", tuple(f))
                if CARD_DIGITS[0] <= total:
                    check = "checksum" if luhn(digits) else "no checksum"
                    yield Candidate(start, b, "card", (*f, check, f"{check} {total}"))
                if 7 <= total <= PHONE_DIGITS[1]:
                    yield Candidate(start, b, "phone", tuple(f))


def candidates(text: str, taken: list[Span]) -> list[Candidate]:
    """Candidate segments that touch no span of ``taken``, by end and start."""
    marks = sorted((s, e) for s, _, e in taken)
    merged: list[list[int]] = []
    for s, e in marks:
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    ends = [e for _, e in merged]

    def free(c: Candidate) -> bool:
        k = bisect.bisect_right(ends, c.start)
        return k == len(merged) or merged[k][0] >= c.end

    return sorted((c for source in (_emails, _numbers) for c in source(text) if free(c)), key=lambda c: (c.end, c.start, c.kind))


# the field


@dataclass(frozen=True)
class Field:
    """Weights by (kind, feature), and the weight of a segment that begins where another ends."""

    weights: dict[tuple[str, str], float]
    adjacent: float

    def score(self, c: Candidate) -> float:
        return sum(self.weights.get((c.kind, f), 0.0) for f in c.features)


def decode(field: Field, found: list[Candidate], margin: float = MARGIN) -> list[Span]:
    """The best segmentation: candidates (by end) against single code points of no kind, which score 0."""
    # a segment of no worth is in no best segmentation, even where it joins two others
    scored = [(c, s) for c in found if (s := field.score(c) - margin) > -2 * max(0.0, field.adjacent)]
    ends = [c.end for c, _ in scored]
    plain: list[tuple[float, int]] = [(0.0, -1)]  # best among the first k candidates, and the last of them in it
    own: list[tuple[float, int]] = []  # best that ends with candidate k, and the candidate before it
    for k, (c, s) in enumerate(scored):
        apart, before = bisect.bisect_left(ends, c.start, 0, k), bisect.bisect_right(ends, c.start, 0, k)
        value, last = max([plain[apart], *((own[p][0] + field.adjacent, p) for p in range(apart, before))])
        own.append((value + s, last))
        plain.append((own[k][0], k) if own[k][0] > plain[-1][0] else plain[-1])
    out, k = [], plain[-1][1]
    while k >= 0:
        c = scored[k][0]
        out.append((c.start, c.kind, c.end))
        k = own[k][1]
    return out[::-1]


# training


def _letters(rng: random.Random, least: int = 3, most: int = 8) -> str:
    return "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(least, most)))


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _card(rng: random.Random, n: int = 16) -> str:
    head = rng.choice("3456") + _digits(rng, n - 2)
    return next(head + d for d in "0123456789" if luhn(head + d))


def written_form(rng: random.Random, kind: str) -> str:
    """Personal data of the kind in a form that the patterns miss."""
    if kind == "email":
        local = rng.choice([_letters(rng), f"{_letters(rng)}.{_letters(rng)}", f"{_letters(rng)}.{rng.randint(1, 99)}", f"{_letters(rng)}_{_letters(rng)}"])
        at, dot = rng.choice([(" (at) ", " (dot) "), (" [at] ", " [dot] "), (" at ", " dot "), (" @ ", " . "), ("(at)", "."), ("[at]", "[dot]"), ("@", "[.]"), (" AT ", " DOT "), (" (at) ", "."), ("@", " dot "), ("@", "(dot)")])
        return local + at + dot.join([*(_letters(rng) for _ in range(rng.choice([1, 1, 2]))), rng.choice(["com", "org", "net", "de", "fr", "es", "info", "edu", "io"])])
    if kind == "ip":
        return rng.choice(["[.]", "(.)", " . ", "[.]", "{.}"]).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        sep = rng.choice([".", "/", "  ", " - ", "_", " . "])
        card = _card(rng, 15) if rng.random() < 0.2 else _card(rng)
        cuts = [0, 4, 10, 15] if len(card) == 15 else [0, 4, 8, 12, 16]
        return sep.join(card[a:b] for a, b in zip(cuts, cuts[1:]))
    a, b, c = _digits(rng, 3), _digits(rng, 3), _digits(rng, 4)
    a = rng.choice("23456789") + a[1:]
    plain = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"({a}) {b} {c}", f"{a}.{b}.{c}", f"1 ({a}) {b}-{c}", f"({a}){b}-{c}", f"00{rng.randint(1, 99)} {a} {b}{c}", f"00{rng.randint(1, 99)} {a} {b} {c}"]
    cued = [f"0{_digits(rng, 2)}/{_digits(rng, 7)}", f"0{_digits(rng, 3)} {_digits(rng, 6)}", f"{a} {b} {c}", f"0{_digits(rng, 1)} {_digits(rng, 2)} {_digits(rng, 2)} {_digits(rng, 2)} {_digits(rng, 2)}"]
    if rng.random() < 0.3:
        return rng.choice(["tel", "Tel.", "phone:", "call", "Telefon", "fax", "mobile"]) + " \0" + rng.choice(cued + plain)
    return rng.choice(plain)


def other_number(rng: random.Random) -> str:
    """Numbers and words that are no personal data but look a little like it."""
    d = lambda n: _digits(rng, n)
    year = f"{rng.choice(['19', '20'])}{d(2)}"
    failing = _card(rng)
    failing = failing[:-1] + str((int(failing[-1]) + rng.randint(1, 9)) % 10)
    sep = rng.choice([".", "/", "-", " ", "  ", "_"])
    return rng.choice([
        f"{year}-{d(2)}-{d(2)}", f"{d(2)}.{d(2)}.{year}", f"{d(2)}/{d(2)}/{year} {d(2)}:{d(2)}", f"{d(1)}.{d(8)}", f"{d(1)},{d(3)},{d(3)}", f"{d(1)} {d(3)} {d(3)}", f"ISBN 978-{d(1)}-{d(2)}-{d(6)}-{d(1)}",
        f"{year}-{year}", f"{year} {year} {year}", f"no. {d(8)}", f"id {d(10)}", failing, d(16), d(12), d(9), d(20), sep.join(failing[k:k + 4] for k in range(0, 16, 4)), f"{rng.randint(256, 999)}[.]{d(2)}[.]{d(3)}[.]{d(2)}",
        f"v{d(1)}.{d(1)}.{d(2)}", f"${d(3)}.{d(2)}", f"{d(3)} {d(3)} {d(3)} {d(3)} {d(3)} {d(3)}", f"{d(2)} {d(2)} {d(2)} {d(2)}", f"{d(3)}/{d(4)}", f"({d(4)}) {d(4)}", f"{d(3)}-{d(3)}-{d(3)}-{d(3)}-{d(3)}",
        f"{_letters(rng)} at {_letters(rng)}.", f"look at {_letters(rng)}. {_letters(rng).title()} {_letters(rng)}", f"at {_letters(rng)} . {_letters(rng)}", f"a dot at {_letters(rng)} {_letters(rng)}", f"{_letters(rng)} at the dot {_letters(rng)}",
        f"{_letters(rng)} @ {d(2)}.{d(2)}", f"#{d(7)}", f"{d(4)}-{d(4)}", f"{d(5)} {d(5)}", f"{year}/{d(2)}/{d(3)}/{d(4)}", f"token = \"{d(3)}a{d(9)}f{d(7)}\"", f"{d(2)}, {d(2)}, {d(2)}, {d(2)}", f"{d(2)}% {d(2)}% {d(3)}"])


def examples(windows: list[str], forms: int = FORMS, seed: int = 17) -> list[tuple[str, set[Span]]]:
    """Windows with written forms and other numbers put between their words, and the forms' spans."""
    rng, out = random.Random(seed), []
    windows = windows or [" ".join(_letters(rng) for _ in range(20)) for _ in range(50)]
    for n in range(forms):
        words = windows[n % len(windows)].split(" ")[:24]
        text, spans = "", set()
        for k in sorted(rng.randrange(len(words) + 1) for _ in range(rng.randint(1, 2))):
            form, kind = (other_number(rng), None) if rng.random() < 0.5 else (written_form(rng, kind := rng.choice(KINDS)), kind)
            head = " ".join(words[:k])
            words = words[k:]
            text += head + (" " if head else "")
            cue, _, form = form.rpartition("\0")
            text += cue
            if kind:
                spans.add((len(text), kind, len(text) + len(form)))
            text += form + rng.choice([" ", " ", ". ", ", "])
        out.append((text + " ".join(words), spans))
    return out + [(w, set()) for w in windows]


def _sums(starts: np.ndarray, ends: np.ndarray, scores: np.ndarray, adjacent: float) -> tuple[float, np.ndarray, float]:
    """log of the sum over all segmentations, probability of each candidate, expected number of adjacent pairs.

    Forward and backward over the positions where candidates start or end; between them are single code points of no kind.
    """
    places = sorted({*starts.tolist(), *ends.tolist()})
    at = {p: k for k, p in enumerate(places)}
    n = len(places)
    begins: list[list[int]] = [[] for _ in range(n)]
    for k, s in enumerate(starts.tolist()):
        begins[at[s]].append(k)
    stop = [at[e] for e in ends.tolist()]
    s = np.minimum(scores, 60.0).tolist()
    joined = math.exp(min(adjacent, 30.0))
    # plain[k]: reached by a code point of no kind (or at the beginning), segment[k]: by a segment that ends there
    weight = [math.exp(x) for x in s]
    plain, segment = [0.0] * n, [0.0] * n
    plain[0] = 1.0
    for k in range(n):
        if k:
            plain[k] += plain[k - 1] + segment[k - 1]
        reach = plain[k] + joined * segment[k]
        for c in begins[k]:
            segment[stop[c]] += reach * weight[c]
    # after_plain[k], after_segment[k]: all ways on from there
    after_plain, after_segment = [0.0] * n, [0.0] * n
    after_plain[-1] = after_segment[-1] = 1.0
    for k in range(n - 2, -1, -1):
        by_segments = sum(weight[c] * after_segment[stop[c]] for c in begins[k])
        after_plain[k] = after_plain[k + 1] + by_segments
        after_segment[k] = after_plain[k + 1] + joined * by_segments
    total = plain[-1] + segment[-1]
    p, pairs = np.zeros(len(s)), 0.0
    for k in range(n):
        for c in begins[k]:
            on = weight[c] * after_segment[stop[c]] / total
            p[c] = (plain[k] + joined * segment[k]) * on
            pairs += joined * segment[k] * on
    return math.log(total), p, pairs


def train(rows: list[tuple[str, set[Span]]], passes: int = PASSES, l2: float = L2) -> Field:
    """Weights of the greatest conditional likelihood (gradient steps with moments), less an L2 term."""
    index: dict[tuple[str, str], int] = {}
    lattices, gold = [], []
    for text, spans in rows:
        found = candidates(text, base_spans(text))
        if found:
            features = [[index.setdefault((c.kind, f), len(index)) for f in c.features] for c in found]
            # a segment of the lattice: code points of no kind lie between any two places that are not equal
            lattices.append((np.array([c.start for c in found]), np.array([c.end for c in found]), features))
            gold.append(np.array([(c.start, c.kind, c.end) in spans for c in found], float))
    if not lattices:
        return Field({}, 0.0)
    cell = np.array([f for _, _, fs in lattices for row in fs for f in row])
    lengths = [len(row) for _, _, fs in lattices for row in fs]
    row = np.repeat(np.arange(len(lengths)), lengths)
    cuts = np.concatenate([[0], np.cumsum([len(fs) for _, _, fs in lattices])])
    truth = np.concatenate(gold)
    w, first, second, adjacent = np.zeros(len(index) + 1), np.zeros(len(index) + 1), np.zeros(len(index) + 1), 0.0
    for step in range(1, passes + 1):
        scores = np.bincount(row, w[cell], len(lengths))
        p, pairs = np.zeros(len(lengths)), 0.0
        for k, (starts, ends, _) in enumerate(lattices):
            _, p[cuts[k]:cuts[k + 1]], more = _sums(starts, ends, scores[cuts[k]:cuts[k + 1]], w[-1])
            pairs += more
        slope = np.append(np.bincount(cell, (truth - p)[row], len(index)), -pairs) - l2 * w
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        w += 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Field({key: round(float(w[k]), 6) for key, k in index.items()}, round(float(w[-1]), 6))


def fit(docs: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> Field:
    """A field trained on windows of at most ``sample`` different texts, those of the least hashes, however often each occurs."""
    t = docs.select(F.col(text_col).alias("text")).filter(F.length("text") > 0).select(F.xxhash64("text").alias("h"), "text")
    least = t.select("h").distinct().orderBy("h").limit(sample)
    window = F.substring(F.col("text"), (F.pmod(F.col("h"), F.greatest(F.length("text") - WINDOW, F.lit(1))) + 1).cast("int"), F.lit(WINDOW))
    rows = t.join(F.broadcast(least), "h").groupBy("h").agg(F.min(window).alias("window")).orderBy("h").collect()  # ``sample`` rows
    return train(examples([r.window for r in rows]))


def all_spans(text: str, field: Field, margin: float = MARGIN) -> tuple[list[Span], list[Span]]:
    """(the patterns' spans, those and the field's), each in order."""
    base = base_spans(text)
    found = candidates(text, base)
    return base, in_order(base + decode(field, found, margin)) if found else base


def _finder(field: Field, margin: float):
    def written(spans: list[Span]) -> str:
        return ",".join(f"{k}:{s}:{e}" for s, k, e in spans)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            n = [[0] * batch.num_rows for _ in range(len(KINDS) + 1)]
            digests, spans = [empty] * batch.num_rows, [""] * batch.num_rows
            for at, text in enumerate(texts):
                base, whole = all_spans(text.as_py(), field, margin)
                if not whole:
                    continue
                for _, kind, _ in base:
                    n[KINDS.index(kind)][at] += 1
                n[-1][at] = len(whole) - len(base)
                digests[at], spans[at] = hashlib.sha256(written(base).encode()).hexdigest(), written(whole)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in n[:-1]), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(n[-1], pa.int64())],
                                             names=[c.split()[0] for c in RESULT.split(", ")])

    return rows


def find(docs: DataFrame, field: Field, margin: float = MARGIN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the patterns' counts and digest, all spans, and how many the field added."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_finder(field, margin), RESULT)
