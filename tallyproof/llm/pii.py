"""Personal data: base patterns, and spans of other forms found by a character tagger.

The patterns find the plain forms of e-mail addresses, IP addresses, card and phone numbers. A
bidirectional LSTM with CRF transitions (``tagger``), trained on spans that the patterns label in a
bounded sample of the table and on rewritten forms of them, finds forms that the patterns miss:
bracketed or spelled-out separators ("jane dot roe at mail dot com"), phone numbers without a plus sign, grouped cards.

Every text is covered by windows of 128 characters that overlap by half. All four kinds need a digit,
an at sign, an at in brackets or the bare word "dot", also in the rewritten forms, and ``plausible`` asks for one inside
the span; a window that holds none whole can therefore add nothing and is not decoded. The decoded
spans of all windows of a text are reconciled: a span cut by the border of a window, or within ``EDGE`` of it, is left
to the neighbour that holds it whole; where none does, a window centred on the span is decoded, and a wider
one as long as a border cuts it, so that a span's place in the text does not matter. Of overlapping
spans the one with most windows, then the longest, then the first stays; spans that touch a base span
go. What remains must pass the same arithmetic as the base forms (Luhn, octets, number of digits), and
no longer than ``LONGEST`` characters, some six times the longest address that mail allows.

Defined results: null and empty texts have no spans. Repeated rows are searched each. A table
without base spans trains on generated ones alone. Counts and ``base_sha256`` are of base spans.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyproof.llm import tagger
from tallyproof.llm.common import fields, keeps_columns, mapped, table, without
from tallyproof.llm.tagger import KINDS

# EDGE: characters next to a window's border where the tagger lacks context; spans there count as cut.
WINDOW, STRIDE, EDGE, LONGEST = 128, 64, 16, 2048
# Documents whose base spans are the labelled sample, in the order of a hash of their ids; spans
# taken of each; generated sequences; training steps.
SAMPLE_DOCS, SAMPLE_SPANS = 400, 4
SEQUENCES, LENGTH, STEPS, BATCH, RATE, SEED = 6000, 80, 600, 32, 0.02, 11

# What every form of a span holds: a digit, an at sign, an at in brackets, or the word dot (``plausible``).
SIGN = re.compile(r"[0-9@]|[\[({<] ?at ?[\])}>]|(?<=\s)dot(?=\s)", re.I)
# An address in bare words. Without "dot" it would read like any place ("open at noon").
SPELLED = re.compile(r"[a-z0-9._%+-]+(?:\sdot\s[a-z0-9_%+-]+)*\sat\s[a-z0-9-]+(?:\sdot\s[a-z0-9-]+)+", re.I)
AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Matches start at the first digit of a run, as a match that fails there fails inside it too.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """Spans of the four patterns, by start, then kind."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = AFTER_AT.match(text, at) if start < at else None
        if match:
            out.append(Span(start, 0, match.end()))
            done = match.end()
        at = text.find("@", max(at + 1, done))
    if any(c in text for c in "0123456789"):
        out += [Span(m.start(), 1, m.end()) for m in IP.finditer(text) if octets(m[0].split("."))]
        for m in CARD.finditer(text):
            if 14 <= m.end() - m.start() and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                out.append(Span(m.start(), 2, m.end()))
        if "+" in text:
            out += [Span(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(out)


def shown(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def plausible(kind: int, text: str) -> bool:
    """The arithmetic of a kind, whatever its separators."""
    digits = digits_of(text)
    if kind == 0:
        return bool(SPELLED.search(text)) or bool(re.search(r"(@|[\[({<] ?at ?[\])}>])", text, re.I)) and bool(re.search(r"(\.|[\[({<] ?dot ?[\])}>])[A-Za-z]", text.replace(" ", ""), re.I))
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and octets(parts)
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits) and not re.search(r"[A-Za-z]", text)
    return 10 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", text) and len(set(digits)) > 2


def rewritten(kind: int, chance: random.Random) -> str:
    """A generated span in one of the forms a person writes."""
    word = lambda: "".join(chance.choice("abcdefghijklmnoprstuvwy") for _ in range(chance.randint(2, 9)))
    number = lambda n: "".join(chance.choice("0123456789") for _ in range(n))
    if kind == 0:
        local = word() + chance.choice(["", ".", "_", "-", "+"]) + chance.choice([word(), number(2)])
        host = [word() + chance.choice(["", number(1)]) for _ in range(chance.randint(1, 2))] + [chance.choice(["com", "net", "org", "de", "fr"])]
        at, dot = chance.choice([("@", "."), ("@", "."), (" [at] ", " [dot] "), ("[at]", "."), (" (at) ", "."), (" (at) ", " (dot) "), (" @ ", "."), ("@", "[.]"), (" at ", " dot "), (" at ", " dot "), (" at ", " dot "), (" at ", " dot ")])
        case = chance.choice([str, str, str, str.upper, str.title])
        if at == " at " and chance.random() < 0.4:
            local = f"{word()}{case(dot)}{word()}"
        return local + case(at) + case(dot).join(host)
    if kind == 1:
        mark = chance.choice([".", ".", "[.]", "(.)", " . ", "[.]"])
        return mark.join(str(chance.randint(1, 255)) for _ in range(4))
    if kind == 2:
        body = number(15)
        body += next(d for d in "0123456789" if luhn(body + d))
        mark = chance.choice(["", " ", "-", ".", "  ", "/", "_", " - "])
        return mark.join(body[i : i + 4] for i in range(0, 16, 4))
    a, b, c = number(3), number(3), number(4)
    form = chance.choice(["+1 ({}) {}-{}", "+{}{}{}", "({}) {}-{}", "({}) {} {}", "{}-{}-{}", "{}.{}.{}", "00 49 {} {} {}", "tel:{}-{}-{}", "+1.{}.{}.{}", "1-{}-{}-{}"])
    return form.format(a, b, c)


def decoy(chance: random.Random) -> str:
    """Text with digits or at signs that is no personal data."""
    number = lambda n: "".join(chance.choice("0123456789") for _ in range(n))
    return chance.choice([
        lambda: "".join(chance.choice("0123456789abcdef") for _ in range(chance.choice([8, 16, 32, 40]))),
        lambda: f"{chance.choice(['sk', 'api', 'key', 'ghp'])}_{''.join(chance.choice('abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789') for _ in range(24))}",
        lambda: f"{chance.randint(0, 12)}.{chance.randint(0, 20)}",
        lambda: f"{chance.randint(0, 12)}.{chance.randint(0, 20)}.{chance.randint(0, 20)}",
        lambda: str(chance.randint(1900, 2030)),
        lambda: f"{chance.randint(1900, 2030)}-{chance.randint(10, 12)}-{chance.randint(10, 28)}",
        lambda: f"{chance.randint(1, 23)}:{number(2)}:{number(2)}",
        lambda: number(chance.randint(1, 9)),
        lambda: number(chance.randint(20, 30)),
        lambda: f"{number(3)},{number(3)}.{number(2)}",
        lambda: f"@{chance.choice(['the', 'user', 'team'])}{number(1)}",
        lambda: f"version {chance.randint(1, 9)}.0",
        lambda: f"({chance.randint(1, 99)})",
        lambda: f"at {chance.choice(['the', 'noon', 'that', 'home', 'this stage'])}",
        lambda: chance.choice(["the dot", "a dot on", "dot by dot", "dot com", "at a dot", "at the dot of", "total", "data", "today"]),
    ])()


def sequences(snippets: list[tuple[str, list[Span]]], count: int, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Class and tag sequences: labelled snippets as they are, and snippets with rewritten spans and
    decoys put between their words."""
    chance = random.Random(seed)
    x, y = np.zeros((count, length), np.uint8), np.zeros((count, length), np.uint8)
    plain = [t for t, s in snippets if not s] or ["and there was nothing of note on that day, they said"]
    labelled = [p for p in snippets if p[1]]
    for i in range(count):
        if labelled and i % 4 == 0:
            text, spans = chance.choice(labelled)
        else:
            parts, spans, size = [], [], 0
            words = chance.choice(plain).split() or ["a"]
            while size < length + 8:
                draw = chance.random()
                kind = chance.randrange(4) if draw < 0.14 else -1
                part = rewritten(kind, chance) if kind >= 0 else decoy(chance) if draw < 0.3 else chance.choice(words)
                lead = len(part) - len(part.removeprefix("tel:"))
                if kind >= 0:
                    spans.append(Span(size + lead, kind, size + len(part)))
                tail = chance.choice(["", "", "", ",", ".", "%%%", "***"]) + chance.choice([" ", " ", " ", "\n"])
                parts.append(part + tail)
                size += len(part) + len(tail)
            text = "".join(parts)
        shift = chance.randint(0, max(0, len(text) - length))
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)[shift : shift + length]
        x[i, : len(points)] = tagger.classes(points)
        for span in spans:
            a, b = span.start - shift, span.end - shift
            if a >= 0 and b <= length:
                y[i, a] = 1 + 2 * span.kind
                y[i, a + 1 : b] = 2 + 2 * span.kind
            elif a < length and b > 0:
                x[i, max(0, a) : b] = tagger.PAD  # a span cut by the border teaches nothing
    return x, y


def snippets_of(docs: DataFrame, most: int = SAMPLE_DOCS, doc_id: str = "doc_id", text: str = "text") -> list[tuple[str, list[Span]]]:
    """Labelled snippets of at most ``most`` documents: bounded by parameters, whatever the texts' length."""
    body, ident = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    likely = docs.where(body.rlike(r"@[A-Za-z0-9]|\+[0-9]|[0-9]\.[0-9]|[0-9]{4}")).select(ident.alias("id")).where("id IS NOT NULL")
    # at most ``most`` ids: a bounded broadcast
    chosen = likely.distinct().orderBy(F.xxhash64("id"), "id").limit(most)
    rows = docs.select(ident.alias("id"), body.alias("text")).join(F.broadcast(chosen), "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = [], []
            for i, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for span in base_spans(body or "")[:SAMPLE_SPANS]:
                    ids.append(str(i))
                    parts.append(body[max(0, span.start - 60) : span.end + 60])
                ids.append(str(i))
                parts.append((body or "")[:WINDOW])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(parts, pa.string())], ["id", "part"])

    found = mapped(rows, work, "id string, part string").distinct().orderBy(F.xxhash64("id", "part"), "id", "part")
    return [(r["part"], base_spans(r["part"])) for r in found.limit(most * (SAMPLE_SPANS + 1)).collect()]


def fitted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> dict[str, np.ndarray]:
    x, y = sequences(snippets_of(docs, doc_id=doc_id, text=text), SEQUENCES, LENGTH, SEED)
    return tagger.trained(x, y, STEPS, BATCH, RATE, SEED)


def reconciled(text: str, base: list[Span], votes: dict[Span, int]) -> list[Span]:
    """Base spans and the voted spans that agree with them, with one another and with arithmetic."""
    taken = list(base)
    order = sorted(votes, key=lambda s: (-votes[s], s.start - s.end, s))
    for span in order:
        body = text[span.start : span.end]
        beside = text[span.start - 1 : span.start] + text[span.end : span.end + 1]
        if len(body) > LONGEST or any(c.isalnum() for c in beside) or not plausible(span.kind, body):
            continue
        if all(span.end <= t.start or t.end <= span.start for t in taken):
            taken.append(span)
    return sorted(taken)


class Window(NamedTuple):
    text: int
    start: int
    end: int


def decoded_spans(kinds: list[np.ndarray], windows: list[Window], model: dict[str, np.ndarray]) -> Iterator[tuple[Window, Span, bool]]:
    """Spans of ``windows``, shortest first, with whether a border inside the text
    cuts them or is too near to judge."""
    rows = max(1, 1024 * WINDOW // max(w.end - w.start for w in windows))
    for i in range(0, len(windows), rows):
        block = windows[i : i + rows]
        width = max(WINDOW, *(w.end - w.start for w in block))
        x = np.zeros((len(block), width), np.uint8)
        for row, (n, a, b) in zip(x, block, strict=True):
            row[: b - a] = kinds[n][a:b]
        for tags, window in zip(tagger.decoded(model, x), block, strict=True):
            n, a, b = window
            if not tags.any():
                continue
            for kind, s, e in tagger.spans_of(tags[: b - a]):
                cut = (s < EDGE and a > 0) or (e > b - a - EDGE and b < len(kinds[n]))
                yield window, Span(a + s, kind, a + e), cut


def joined_cuts(cuts: set[tuple[int, Span]]) -> list[tuple[int, Span]]:
    """Unions of the cut spans of one text and kind that overlap; a run of more than ``LONGEST``
    characters is no span."""
    out: list[tuple[int, Span]] = []
    for n, span in sorted(cuts, key=lambda c: (c[0], c[1].kind, c[1])):
        if out and out[-1][0] == n and out[-1][1].kind == span.kind and span.start < out[-1][1].end:
            span = Span(out[-1][1].start, span.kind, max(out[-1][1].end, span.end))
            out.pop()
        out.append((n, span))
    return [c for c in out if c[1].end - c[1].start <= LONGEST]


def found_spans(texts: list[str], model: dict[str, np.ndarray]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each text."""
    base = [base_spans(t) for t in texts]
    votes: list[dict[Span, int]] = [{} for _ in texts]
    kinds, windows = [], []
    for n, text in enumerate(texts):
        signs = np.array([m.span() for m in SIGN.finditer(text)], np.int64).reshape(-1, 2)
        if not len(signs):
            kinds.append(np.empty(0, np.uint8))
            continue
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        kinds.append(tagger.classes(points))
        starts = np.arange(0, max(1, len(points) - WINDOW + STRIDE), STRIDE)
        ends = np.minimum(starts + WINDOW, len(points))
        # the first sign from a window's start on must end in it
        after = np.append(signs[:, 1], len(points) + 1)[np.searchsorted(signs[:, 0], starts)]
        windows += [Window(n, a, b) for a, b in zip(starts[after <= ends].tolist(), ends[after <= ends].tolist(), strict=True)]
    centre: dict[Window, list[Span]] = {}
    margin = STRIDE
    while windows:
        cuts: set[tuple[int, Span]] = set()
        for window, span, cut in decoded_spans(kinds, windows, model):
            if not cut:
                votes[window.text][span] = votes[window.text].get(span, 0) + 1
            elif not centre or any(span.start < c.end and c.start < span.end for c in centre[window]):
                cuts.add((window.text, span))
        # one that a window held whole needs no other; a wider window follows only what it is
        # centred on, so that no span is cut any more once the margin exceeds LONGEST
        open_cuts = {(n, c) for n, c in cuts if not any(v.start <= c.start and c.end <= v.end for v in votes[n])}
        centre = {}
        for n, c in joined_cuts(open_cuts):
            window = Window(n, max(0, c.start - margin), min(len(kinds[n]), c.end + margin))
            centre.setdefault(window, []).append(c)
        windows = sorted(centre, key=lambda w: w.end - w.start)
        margin *= 2
    return [(b, reconciled(t, b, v)) for t, b, v in zip(texts, base, votes, strict=True)]


def searched(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text", redact: bool = False) -> DataFrame:
    """``docs`` with base and spans (kind:start:end, comma-joined) and n_email to n_phone of the base
    ones; ``redact`` replaces every span in the text by its kind in square brackets."""
    added = ["base", "spans", *(f"n_{k}" for k in KINDS)]
    chosen = docs.select(*without(docs, *added))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                bodies = part.column(at).to_pylist()
                found = found_spans([b or "" for b in bodies], sent.value)
                columns = list(part.columns)
                if redact:
                    columns[at] = pa.array([None if b is None else redacted(b, f[1]) for b, f in zip(bodies, found, strict=True)], pa.string())
                columns += [pa.array([shown(f[k]) for f in found], pa.string()) for k in (0, 1)]
                for kind in range(len(KINDS)):
                    columns.append(pa.array([sum(s.kind == kind for s in f[0]) for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, *added])

    return mapped(chosen, work, f"{fields(chosen)}, base string, spans string, {', '.join(f'n_{k} long' for k in KINDS)}")


def redacted(text: str, spans: list[Span]) -> str:
    """``text`` with its spans replaced; overlapping spans become one replacement."""
    parts, done = [], 0
    for span in spans:
        if span.end <= done:
            continue
        if span.start >= done:
            parts.append(text[done : span.start] + f"[{KINDS[span.kind].upper()}]")
        done = span.end
    return "".join([*parts, text[done:]])


def op10_lstm_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = searched(docs, fitted(docs))
    return found.select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256"), "spans")


@keeps_columns
def redact_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage: personal data replaced; ``n_chars`` follows the text."""
    out = searched(docs, fitted(docs), redact=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*(f"`{c}`" for c in docs.columns))
