"""Personal data: fixed patterns, and candidates that boosted trees accept.

Generous generators propose spans that overlap.  Trees see a candidate's format and the
words around it, but neither what proposed it nor the checks by which fixed patterns pass
or fail (check digits, a leading plus), so what they learn carries over to candidates that
no fixed pattern takes: a phone number without its plus, an address spelled out.  Every
confirmed address is shown to them spelled out as well.
They are fitted on a bounded sample of candidates (``SAMPLE``, the same for each kind,
chosen by hash, equal texts once): those that fixed patterns found are the positives, the
other number groups the negatives.  For each kind a threshold is set by what fixed patterns
confirm among all candidates of all texts, counted by bins of their score.

Null and empty texts have no spans; repeated rows are scanned alike; other columns pass
through; a column that is already called ``spans`` is replaced; an empty table stays so.
The work grows with the length of a text, also where it is full of numbers.  Accepted
candidates that overlap: the longest stays, of equally long ones the first, then the one of
the kind listed first.  A sample without both labels or of fewer than ``LEAST`` gives
the base spans only.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.llm import boosting
from runlens.llm.registry import query
from runlens.llm.shared import drop, load, new_folder
from runlens.llm.spans import Span, Taken, add_spans, count_of, joined

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "more_email", "more_ip", "more_card", "more_phone")

#: Most candidates that the trees are fitted on, and the least share of candidates beyond a
#: threshold that fixed patterns confirm.  Some of the others are right all the same: the
#: patterns miss them, which is why they are looked for.
SAMPLE = 20_000
LEAST = 50
PRECISION = 0.85
#: Share of a kind's confirmed candidates beyond its threshold: no lower than these need it,
#: so that what scores worse than confirmed ones do is not let in.
RECALL = 0.98

#: Lower ends of the score bins that thresholds are set on: logits from -30 to 30.
EDGES = 1 / (1 + np.exp(-np.linspace(-30, 30, 3001)))

# Patterns whose every start would read a long run of characters again are tried at the
# start of the run only; there they find the same.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
AT = re.compile("@")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Addresses, also spelled out: what follows the local part, and the rest.
SIGN = re.compile(r" ?(?:@|\(at\)|\[at\]| at ) ?")
SPELLED = re.compile(r"[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]++)+")

# Proposals of numbers: kind and pattern.
NUMBERS = (
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9])")),
    ("card", re.compile(r"(?<![0-9])[0-9](?:[ .-]?[0-9]){12,18}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9])\(?[0-9](?:[ ()./-]{0,2}[0-9]){6,14}(?![0-9])")),
)

COUNTRY = re.compile(r"^[0-9]{1,3}[ .-]+")

#: Any text with a span or a proposal matches this: the first steps of the e-mail generator,
#: four digits as near as in any other generator or pattern, and ``PHONE``.
HINT = (
    r"[A-Za-z0-9._%+-] ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]+ ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]"
    r"|[0-9](?:[ ()./-]{0,2}[0-9]){3}"
    r"|\+[0-9][ ().0-9-]+[0-9]"
)

_CONTEXT = {
    "mail": re.compile(r"e-?mail|contact|write|correo|courriel", re.I),
    "phone": re.compile(r"phone|tel|call|fax|mobile|dial|sms", re.I),
    "card": re.compile(r"card|visa|credit|account|iban|karte|tarjeta|carte", re.I),
    "host": re.compile(r"\bip\b|host|server|address|login", re.I),
    "other": re.compile(r"order|invoice|isbn|issn|version|\bno\b|page|date|id\b|ref|#|§|\$|€", re.I),
}
_BEFORE, _AFTER = 40, 20

#: Ways to spell out an address, for what the trees learn, and how they are recognised.
SPELLINGS = ((" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" at ", "."))
SPELLED_AT = re.compile(r"\(at\)|\[at\]| at ")
SPELLED_DOT = re.compile(r"\(dot\)|\[dot\]| dot ")
#: What is hardly written but to spell out an address: such candidates are unlabelled, not
#: wrong.
SURE = re.compile(r"\((?:at|dot)\)|\[(?:at|dot)\]| dot ")
WORDS = re.compile(r"[A-Za-z0-9._%+-]+")
#: Candidates of a text that the trees judge at once.
_TOGETHER = 1 << 14


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def addresses(text: str, sign: re.Pattern, domain: re.Pattern) -> Iterator[tuple[int, int]]:
    """Places of addresses: the local part runs back from the sign, the domain follows it.

    Local parts hold nothing that a sign begins with, so a match begins where its run does
    or where the last match ended.
    """
    end, found = 0, sign.search(text)
    while found:
        start = found.start()
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        rest = domain.match(text, found.end()) if start < found.start() else None
        if rest:
            end = rest.end()
            yield start, end
        found = sign.search(text, max(found.start() + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns; a match that fails its test is dropped, not retried."""
    found = [("email", s, e, True) for s, e in addresses(text, AT, DOMAIN)]
    for m in IP.finditer(text):
        if all(len(n := p.lstrip("0")) <= 3 and int(n or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end(), True))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end(), True))
    for m in PHONE.finditer(text):
        if 8 <= len(_digits(m[0])) <= 15:
            found.append(("phone", m.start(), m.end(), True))
    return found


def features(text: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate, without a plus and the country code it marks."""
    body = text[start:end]
    if text[max(0, start - 1) : start] == "+":
        body = COUNTRY.sub("", body)
    return _described(body, text[max(0, start - _BEFORE) : start], text[end : end + _AFTER])


def _described(body: str, before: str, after: str) -> list[float]:
    digits = _digits(body)
    groups = [len(g) for g in re.findall(r"[0-9]+", body)]
    before = before.rstrip("+")
    words = WORDS.findall(body)
    return [
        len(body),
        len(digits),
        sum(c.isalpha() for c in body),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        groups[0] if groups else 0,
        groups[-1] if groups else 0,
        body.count("."),
        body.count("-"),
        body.count(" "),
        body.count("("),
        body.count("@"),
        body.count("/"),
        len(set(digits)),
        float(digits[:1] or -1),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:].isspace() or not before),
        float(after[:1] in {".", ",", ";", ")"}),
        *(float(p.search(before) is not None) for p in _CONTEXT.values()),
        # Of an address: what is spelled out, the last part of the domain, the local part.
        len(SPELLED_AT.findall(body)),
        len(SPELLED_DOT.findall(body)),
        body.count(". "),
        len(words[-1]) if words else 0,
        float(bool(words) and words[-1].islower()),
        len(words[0]) if words else 0,
        float(bool(words) and any(c in "._%+-" or c.isdigit() for c in words[0])),
    ]


def spelled_out(address: str, turn: int) -> str:
    """An address as people write it against robots, in one of ``SPELLINGS``."""
    at, dot = SPELLINGS[turn % len(SPELLINGS)]
    local, _, domain = address.partition("@")
    return local + at + domain.replace(".", dot)


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Candidate spans of all generators, overlapping ones too."""
    found = [("email", s, e) for s, e in addresses(text, SIGN, SPELLED)]
    return found + [(kind, m.start(), m.end()) for kind, p in NUMBERS for m in p.finditer(text)]


def examples(text: str) -> Iterator[tuple[str, list[float], bool]]:
    """Candidates with their features; positive where a base span has that place.

    A confirmed address comes once more, spelled out at its place; a candidate that is
    surely spelled out has no label and is left out.
    """
    base = base_spans(text)
    free = Taken(base).free
    # Spans of one kind are apart and ascend, so one at most can hold a candidate.
    own = {k: [(s, e) for kind, s, e, _ in base if kind == k] for k in BASE_KINDS}
    for kind, start, end in proposals(text):
        at = bisect_right(own[kind], (start, len(text)))
        low, high = own[kind][at - 1] if at else (0, 0)
        same = end <= high and high - low - (end - start) <= 3
        if not same and (not free(start, end) or SURE.search(text, start, end)):
            continue
        yield kind, features(text, start, end), same
        if same and kind == "email":
            body = spelled_out(text[start:end], start)
            yield kind, _described(body, text[max(0, start - _BEFORE) : start], text[end : end + _AFTER]), True


@dataclass
class Model:
    """Trees for all kinds together and a threshold for each."""

    trees: boosting.Boosted
    limits: dict[str, float]

    def accept(self, found: list[tuple[str, list[float]]]) -> np.ndarray:
        x = np.array([[GENERATOR_PLACE[k], *f] for k, f in found])
        return self.trees.probability(x) >= np.array([self.limits[k] for k, _ in found])


GENERATOR_PLACE = {kind: float(i) for i, kind in enumerate(BASE_KINDS)}


def _hinted(texts: pa.Array) -> pa.Array:
    return pc.match_substring_regex(texts, HINT).fill_null(False)


def _keys(text: str, n: int) -> list[int]:
    """Sampling keys of a text's candidates by their place, the same for equal texts."""
    whole = hashlib.blake2b(text.encode(), digest_size=16)
    keys = []
    for i in range(n):
        own = whole.copy()
        own.update(b":%d" % i)
        keys.append(int.from_bytes(own.digest()[:8], "big") >> 1)
    return keys


def _sample(df: DataFrame, share: int) -> list:
    """For each kind the ``share`` candidates with the smallest keys, equal texts once.

    Each task hands on at most so many of each kind, so does Spark to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, dict[int, tuple]] = {kind: {} for kind in GENERATOR_PLACE}
        for batch in batches:
            for text in batch.column(0).filter(_hinted(batch.column(0))).to_pylist():
                found = list(examples(text))
                for key, (kind, numbers, label) in zip(_keys(text, len(found)), found):
                    kept[kind][key] = (GENERATOR_PLACE[kind], numbers, label, key)
                for kind, own in kept.items():
                    if len(own) > 2 * share:
                        kept[kind] = {k: own[k] for k in sorted(own)[:share]}
        rows = [own[k] for own in kept.values() for k in sorted(own)[:share]]
        columns = list(zip(*rows)) if rows else [()] * 4
        types = [pa.float64(), pa.list_(pa.float64()), pa.bool_(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)],
            names=["place", "features", "label", "key"],
        )

    schema = "place double, features array<double>, label boolean, key long"
    spark = df.sparkSession
    folder = new_folder(spark, "pii-sample")
    df.mapInArrow(run, schema).write.parquet(folder)
    found = spark.read.schema(schema).parquet(folder)
    rows = []
    for place in GENERATOR_PLACE.values():
        own = found.filter(F.col("place") == place).distinct()
        rows += own.orderBy("key", "features", "label").limit(share).collect()
    drop(spark, folder)
    return rows


def _limits(df: DataFrame, trees: boosting.Boosted) -> dict[str, float]:
    """The threshold of each kind, from the scores of all candidates of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(BASE_KINDS), len(EDGES), 2), np.int64)
        for batch in batches:
            texts = batch.column(0).filter(_hinted(batch.column(0))).to_pylist()
            found = [e for t in texts for e in examples(t)]
            if not found:
                continue
            x = np.array([[GENERATOR_PLACE[k], *f] for k, f, _ in found])
            label = np.array([y for *_, y in found], np.int64)
            np.add.at(counts, (x[:, 0].astype(np.int64), _bins(trees.probability(x)), label), 1)
        place, score = np.nonzero(counts.sum(axis=2))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(place, pa.int64()),
                pa.array(score, pa.int64()),
                pa.array(counts[place, score, 1], pa.int64()),
                pa.array(counts[place, score].sum(axis=1), pa.int64()),
            ],
            names=["place", "score", "right", "n"],
        )

    found = df.mapInArrow(run, "place long, score long, right long, n long")
    sums = found.groupBy("place", "score").agg(F.sum("right").alias("right"), F.sum("n").alias("n"))
    right, n = np.zeros((2, len(BASE_KINDS), len(EDGES)), np.int64)
    for r in sums.collect():
        right[int(r["place"]), r["score"]], n[int(r["place"]), r["score"]] = r["right"], r["n"]
    return {kind: _limit(right[i], n[i]) for i, kind in enumerate(BASE_KINDS)}


def _bins(p: np.ndarray) -> np.ndarray:
    return np.clip(np.searchsorted(EDGES, p, side="right") - 1, 0, None)


def _limit(right: np.ndarray, n: np.ndarray) -> float:
    """The highest edge beyond which the wanted share of the confirmed lies, or, if higher,
    the lowest one beyond which the wanted share is confirmed; inf if there is none."""
    above = np.cumsum(n[::-1])[::-1]
    confirmed = np.cumsum(right[::-1])[::-1]
    good = (n > 0) & (confirmed >= PRECISION * above) & (confirmed > 0)
    if not good.any():
        return float("inf")
    needed = np.flatnonzero(confirmed >= RECALL * confirmed[0])[-1]
    return float(EDGES[max(np.argmax(good), needed)])


def fit_model(df: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Model | None:
    """Fit on ``sample`` candidates of all texts; None without both labels or ``LEAST``.

    The sample does not depend on how rows are spread, and every candidate counts for the
    thresholds; only the sample and the counts by score reach the driver.
    """
    texts = df.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = _sample(texts, sample // len(BASE_KINDS))
    if len({r["label"] for r in rows}) < 2 or len(rows) < LEAST:
        return None
    # In the order of the keys, so that those held out to calibrate are of every kind.
    rows.sort(key=lambda r: (r["key"], r["place"]))
    x = np.array([[r["place"], *r["features"]] for r in rows])
    trees = boosting.fit(x, np.array([r["label"] for r in rows]))
    return Model(trees, _limits(texts, trees))


def pii_spans(text: str, model: Model | None) -> list[Span]:
    """Base spans and, apart from them and each other, the accepted candidates."""
    spans = base_spans(text)
    if model is None:
        return spans
    taken = Taken(spans)
    new = [c for c in proposals(text) if taken.free(c[1], c[2])]
    good = [
        c
        for low in range(0, len(new), _TOGETHER)
        for c, ok in zip(
            new[low:], model.accept([(k, features(text, s, e)) for k, s, e in new[low : low + _TOGETHER]])
        )
        if ok
    ]
    # The longest first, then the earliest; of equal places the first generator's.
    for kind, start, end in sorted(good, key=lambda c: (c[1] - c[2], c[1])):
        if taken.free(start, end):
            taken.add(start, end)
            spans.append((f"more_{kind}", start, end, False))
    return spans


def scan_pii(df: DataFrame, text_col: str = "text", model: Model | None = None) -> DataFrame:
    """Add the column ``spans``; ``model`` comes from ``fit_model``."""
    return add_spans(df, text_col, lambda: (_hinted, lambda text: pii_spans(text, model)))


@query("op7_pii_boosting")
def op7_pii_boosting(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents").select("doc_id", "text")
    found = scan_pii(documents, model=fit_model(documents))
    return found.select(
        "doc_id",
        *(count_of(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(joined(KINDS, True, True).cast("binary"), 256).alias("base_sha256"),
        joined(KINDS, True, False).alias("spans"),
    )
