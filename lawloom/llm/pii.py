"""Personal data by a semi-Markov conditional random field.

Rules find the base spans (e-mail, IP address, card and phone number); they always stay.
The field adds spans that the rules miss, such as numbers without their plus sign or
spelt-out addresses. It scores whole candidate segments by features of the whole span
(number of digits and groups, shape, check digit, neighbours); a dynamic program over
segments of at most MAX_TOKENS tokens chooses boundaries and kinds jointly.

Training maximises the conditional likelihood on at most `max_zones` stretches of text
from at most `max_docs` documents, chosen by a hash of their ids, labelled by the rules.
Stretches with and without a rule span have quotas of their own (CLEAN_SHARE of
`max_zones` for those without), each drawn by a hash, so that numbers which are no
personal data are in the sample on a table of any size.
Rule spans are also rewritten there in the ways that the rules do not know, so that the
field learns those. Only stretches around digits, "@" and spelt-out "dot" or "(at)" can
hold an entity; elsewhere the best labelling is known to have none, so the program runs
on those stretches alone, between the base spans, over the whole text.

Positions are code points, ends exclusive. Defined results: a null text is empty and has
no spans; repeated rows are each searched; without anything to learn from, the base
spans are the result; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.common import map_texts, staged, text_or_empty

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 20
#: Longer training stretches are left out; searching has no such limit.
MAX_TRAINING_TOKENS = 80
#: Of the training stretches, those without a rule span at most: a quota of its own, whatever the size of the input.
CLEAN_SHARE = 0.2

_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# the look-behind and possessive runs change no match, they keep long digit runs linear
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    """The check digit of card numbers."""
    values = [int(d) for d in reversed(digits)]
    doubled = [2 * v - 9 if v > 4 else 2 * v for v in values[1::2]]
    return (sum(values[0::2]) + sum(doubled)) % 10 == 0


def _emails(text: str):
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_PART:
            start -= 1
        tail = _EMAIL_TAIL.match(text, at) if start < at else None
        if tail:
            free = tail.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the rules, by start, then kind."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or "0") <= 255 for g in m.groups()):
                found.append(("ip", m.start(), m.end()))
        for m in _CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


# ---- candidate segments ----

_TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^\sA-Za-z0-9]")
#: What makes a word a part of an entity: a digit, an at sign, or one spelt out.
_TRIGGER = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]", re.IGNORECASE)
_SPELT = re.compile(r"[0-9@]|[\[(](?:at|dot)[\])]|(?<!\S)at\s\S+\sdot(?!\S)|(?<!\S)dot(?!\S)", re.IGNORECASE)
_SPACE = re.compile(r"\s")


def _word_start(text: str, at: int, least: int) -> int:
    while at > least and not text[at - 1].isspace():
        at -= 1
    return at


def _word_end(text: str, at: int) -> int:
    space = _SPACE.search(text, at)
    return space.start() if space else len(text)


def zones(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Stretches that may hold an entity: trigger words with a word on either side, less `taken`."""
    trigger = _SPELT if "dot" in text or "DOT" in text else _TRIGGER
    merged: list[list[int]] = []
    at = 0
    while m := trigger.search(text, at):
        a, at = _word_start(text, m.start(), at), _word_end(text, m.end())
        # a neighbour word on either side, if one space away
        if a > 1 and not text[a - 2].isspace():
            a = _word_start(text, a - 1, 0)
        b = _word_end(text, at + 1) if at + 1 < len(text) and not text[at + 1].isspace() else at
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    taken = sorted(taken)
    free, i = [], 0
    for a, b in merged:
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        j = i
        while j < len(taken) and taken[j][0] < b:
            if taken[j][0] > a:
                free.append((a, taken[j][0]))
            a = max(a, taken[j][1])
            j += 1
        if a < b:
            free.append((a, b))
    return free


def _side(char: str) -> str:
    if not char or char.isspace():
        return "_"
    return "d" if char.isdigit() else "a" if char.isalpha() else char


def span_features(text: str, start: int, end: int) -> list[str]:
    """Features of the whole span."""
    span = text[start:end]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    letters = sum(c.isalpha() for c in span)
    shape = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "d", re.sub(r"\s", "_", span)))
    lengths = ",".join(str(min(len(g), 17)) for g in groups[:6])
    low = span.lower()
    out = [
        "bias",
        f"digits{min(len(digits), 21)}",
        f"letters{min(letters, 4)}",
        f"groups{min(len(groups), 6)}",
        f"lengths{lengths}",
        f"shape{shape[:24]}",
        f"left{_side(text[start - 1 : start])}",
        f"right{_side(text[end : end + 1])}",
        f"digits_only{letters == 0}",
    ]
    if len(digits) >= 12 and not letters:
        out.append(f"check{14 <= len(digits) <= 19 and luhn(digits)}")
    if len(groups) == 4 and shape == "d.d.d.d":
        out.append(f"octets{all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    if 10 <= len(digits) <= 15 and not letters:
        out.append(f"dialled{len(groups) > 1}")
    if letters:
        edges = re.findall(r"[0-9]+|[A-Za-z]+", low)
        for name, word in (("first", edges[0]), ("last", edges[-1])):
            out.append(name + (word if word in ("at", "dot") else "d" if word.isdigit() else "a"))
        at = "@" in span or re.search(r"[\[(]at[\])]|\bat\b", low) is not None
        out.append(f"address{at}{'.' in span or re.search(r'[\[(]dot[\])]|\bdot\b', low) is not None}")
    return out


def segments(text: str, zone: tuple[int, int]) -> tuple[list[tuple[int, int]], list[list[tuple[int, list[str]]]]]:
    """(tokens, candidates): for each end token the (first token, features) of entity candidates."""
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text, *zone)]
    candidates: list[list[tuple[int, list[str]]]] = [[] for _ in tokens]
    for a, (start, _) in enumerate(tokens):
        if not (text[start].isalnum() or text[start] in "+("):
            continue
        possible = False
        for b in range(a, min(a + MAX_TOKENS, len(tokens))):
            if b > a and tokens[b][0] - tokens[b - 1][1] > 1 or "\n" in text[tokens[b - 1][1] : tokens[b][0]] and b > a:
                break
            piece = text[tokens[b][0] : tokens[b][1]]
            possible = possible or piece.isdigit() or piece == "@" or piece.lower() in ("at", "dot")
            if possible and piece.isalnum():
                features = span_features(text, start, tokens[b][1])
                # a kind needs digits or an address; anything else is no candidate
                if any(f.startswith("addressTrueTrue") for f in features) or sum(c.isdigit() for c in text[start : tokens[b][1]]) >= 4:
                    candidates[b].append((a, features))
    return tokens, candidates


# ---- the field ----


@dataclass
class SemiMarkovField:
    """Weights of span features by kind, of single outside tokens, and of kinds side by side."""

    ids: dict[str, int] = field(default_factory=dict)
    spans: np.ndarray = field(default_factory=lambda: np.zeros((0, len(KINDS))))
    follow: np.ndarray = field(default_factory=lambda: np.zeros((len(KINDS) + 1, len(KINDS) + 1)))

    @property
    def is_empty(self) -> bool:
        return not len(self.ids)

    def _scores(self, candidates):
        """Candidates as (first token, feature numbers, score of each kind)."""
        out = []
        for at_end in candidates:
            row = []
            for a, features in at_end:
                numbers = [self.ids[f] for f in features if f in self.ids]
                row.append((a, numbers, self.spans[numbers].sum(axis=0)))
            out.append(row)
        return out

    def best(self, text: str, zone: tuple[int, int]) -> list[tuple[str, int, int]]:
        """The best labelling's entities. Label 0 is outside, one token at a time."""
        tokens, candidates = segments(text, zone)
        if not any(candidates):
            return []
        n, labels = len(tokens), len(KINDS) + 1
        score = np.full((n + 1, labels), -np.inf)
        score[0, 0] = 0.0
        back: list[list] = [[None] * labels for _ in range(n + 1)]
        for b, row in enumerate(self._scores(candidates)):
            into = score[b] + self.follow[:, 0]
            k = int(into.argmax())
            score[b + 1, 0], back[b + 1][0] = into[k], (b, k)
            for a, _, values in row:
                for kind in range(1, labels):
                    into = score[a] + self.follow[:, kind]
                    k = int(into.argmax())
                    total = into[k] + values[kind - 1]
                    if total > score[b + 1, kind]:
                        score[b + 1, kind], back[b + 1][kind] = total, (a, k)
        found, at, label = [], n, int(score[n].argmax())
        while at > 0:
            a, before = back[at][label]
            if label:
                found.append((KINDS[label - 1], tokens[a][0], tokens[at - 1][1]))
            at, label = a, before
        return found[::-1]

    def gradient(self, candidates, gold: list[tuple[int, int, int]]):
        """(feature numbers, kind weights) updates and `follow` update: observed less expected."""
        n, labels = len(candidates), len(KINDS) + 1
        rows = self._scores(candidates)
        ahead = np.full((n + 1, labels), -np.inf)
        ahead[0, 0] = 0.0
        for b, row in enumerate(rows):
            ahead[b + 1, 0] = np.logaddexp.reduce(ahead[b] + self.follow[:, 0])
            for a, _, values in row:
                into = np.logaddexp.reduce(ahead[a][:, None] + self.follow[:, 1:], axis=0) + values
                ahead[b + 1, 1:] = np.logaddexp(ahead[b + 1, 1:], into)
        behind = np.full((n + 1, labels), -np.inf)
        behind[n] = 0.0
        total = np.logaddexp.reduce(ahead[n])
        spans, follow = [], np.zeros_like(self.follow)
        for b in range(n - 1, -1, -1):
            step = ahead[b][:, None] + self.follow[:, :1] + behind[b + 1, 0]
            follow[:, :1] -= np.exp(step - total)
            behind[b] = np.logaddexp(behind[b], self.follow[:, 0] + behind[b + 1, 0])
            for a, numbers, values in rows[b]:
                after = values + behind[b + 1, 1:]
                chance = np.exp(ahead[a][:, None] + self.follow[:, 1:] + after - total)
                follow[:, 1:] -= chance
                spans.append((numbers, -chance.sum(axis=0)))
                behind[a] = np.logaddexp(behind[a], np.logaddexp.reduce(self.follow[:, 1:] + after, axis=1))
        at, label = 0, 0
        for a, b, kind in [*gold, (n, n, 0)]:
            for _ in range(at, a):
                follow[label, 0] += 1
                label = 0
            if kind:
                numbers = next(numbers for first, numbers, _ in rows[b] if first == a)
                observed = np.zeros(len(KINDS))
                observed[kind - 1] = 1
                spans.append((numbers, observed))
                follow[label, kind] += 1
                label, at = kind, b + 1
        return spans, follow


def _rewritten(kind: str, span: str, rng: random.Random) -> str:
    """The same datum in a form that the rules do not know."""
    if kind == "email":
        local, _, host = span.partition("@")
        at, dot = rng.choice([(" at ", " dot "), (" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", ".")])
        return rng.choice([local, local.split(".")[0]]) + at + host.replace(".", dot)
    if kind == "phone":
        digits = re.sub(r"\D", "", span)[-10:]
        return rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"]).format(digits[:3], digits[3:6], digits[6:])
    if kind == "card":
        digits = re.sub(r"\D", "", span)
        if len(digits) == 16:
            return rng.choice(["-", " ", ".", "/"]).join(digits[i : i + 4] for i in range(0, 16, 4))
    return span


def training_zones(text: str) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """(stretch, spans in it) around the rules' spans and triggers."""
    spans = base_spans(text)
    out = []
    for a, b in zones(text, []):
        inside = [(k, s, e) for k, s, e in spans if a <= s and e <= b]
        clear = all(x[2] <= y[1] for x, y in zip(inside, inside[1:], strict=False))
        if clear and all(e <= a or s >= b or a <= s and e <= b for _, s, e in spans):
            out.append((text[a:b], [(k, s - a, e - a) for k, s, e in inside]))
    return out


def _examples(stretches, rng: random.Random):
    """Stretches as they are, and those with spans once more with the spans rewritten."""
    for text, spans in stretches:
        yield text, spans
        if spans:
            pieces, moved, at = "", [], 0
            for kind, start, end in spans:
                pieces += text[at:start]
                new = _rewritten(kind, text[start:end], rng)
                moved.append((kind, len(pieces), len(pieces) + len(new)))
                pieces, at = pieces + new, end
            yield pieces + text[at:], moved


def train(stretches: list[tuple[str, list]], epochs: int = 6, rate: float = 0.5, seed: int = 11) -> SemiMarkovField:
    """Stochastic gradient ascent on the conditional likelihood."""
    rng = random.Random(seed)
    model, prepared = SemiMarkovField(), []
    for text, spans in _examples(stretches, rng):
        tokens, candidates = segments(text, (0, len(text)))
        starts, ends = {s: i for i, (s, _) in enumerate(tokens)}, {e: i for i, (_, e) in enumerate(tokens)}
        gold = [(starts.get(s), ends.get(e), KINDS.index(k) + 1) for k, s, e in spans]
        known = all(a is not None and b is not None and any(c[0] == a for c in candidates[b]) for a, b, _ in gold)
        if known and any(candidates) and len(tokens) <= MAX_TRAINING_TOKENS:
            prepared.append((candidates, gold))
    for candidates, _ in prepared:
        for row in candidates:
            for _, features in row:
                for f in features:
                    model.ids.setdefault(f, len(model.ids))
    model.spans = np.zeros((len(model.ids), len(KINDS)))
    for epoch in range(epochs):
        rng.shuffle(prepared)
        step = rate / (1 + epoch)
        for candidates, gold in prepared:
            spans, follow = model.gradient(candidates, gold)
            for numbers, change in spans:
                np.add.at(model.spans, numbers, step * change / 4)
            model.follow += step * follow / 4
        model.spans *= 1 - 1e-3
    return model


def fit_field(docs: DataFrame, max_docs: int = 4_000, max_zones: int = 800, seed: int = 5) -> SemiMarkovField:
    """Model from a bounded sample of documents that hold a digit or an at sign."""
    telling = docs.filter(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]"))
    order = F.xxhash64(F.lit(seed), "doc_id")
    chosen = telling.select("doc_id").distinct().orderBy(order, "doc_id").limit(max_docs).withColumnRenamed("doc_id", "chosen")

    def stretches(batches):
        for batch in batches:
            rows = [(t, [f"{k}:{s}:{e}" for k, s, e in spans]) for text in batch.column(0).to_pylist() for t, spans in training_zones(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.string()))],
                ["stretch", "spans"],
            )

    sample = docs.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen")).select("text")  # max_docs ids
    found = map_texts(sample, stretches, "stretch string, spans array<string>").filter(F.length("stretch") < 1000)
    drawn = staged(found.distinct(), "training-stretches")  # of max_docs documents
    clean_zones = int(max_zones * CLEAN_SHARE)
    order = (F.xxhash64("stretch"), "stretch")
    rows = [
        row
        for own, quota in ((F.size("spans") > 0, max_zones - clean_zones), (F.size("spans") == 0, clean_zones))
        for row in drawn.filter(own).orderBy(*order).limit(quota).collect()
    ]
    parse = lambda s: (s.split(":")[0], *map(int, s.split(":")[1:]))
    return train([(r["stretch"], [parse(s) for s in r["spans"]]) for r in rows])


def all_spans(text: str, model: SemiMarkovField) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, is_base) of base and added spans, by start, then kind."""
    base = base_spans(text)
    found = [(k, s, e, True) for k, s, e in base]
    if not model.is_empty:
        for zone in zones(text, [(s, e) for _, s, e in base]):
            found += [(k, s, e, False) for k, s, e in model.best(text, zone)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def find_personal_data(docs: DataFrame, model: SemiMarkovField) -> DataFrame:
    """(doc_id, spans): array of (kind, start, end, base) for every row of `docs`."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def search(batches):
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            spans = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in all_spans(t, model)] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], ["doc_id", "spans"])

    kinds = "array<struct<kind: string, start: int, end: int, base: boolean>>"
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))
    return map_texts(plain, search, f"doc_id long, spans {kinds}")
