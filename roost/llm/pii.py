"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Positions are code points, ends exclusive. Each kind is read left to right
without overlaps; a proposal that fails its check is dropped and not tried
again. The scans are linear in the text: runs of allowed characters are found
once, and each proposal is settled inside its run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roost.llm.batches import ready_workers, slices

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "number")

LOCAL_PART = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGIT_RUN = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE_TAIL = re.compile(r"[ ().0-9-]*")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
# Lengths of account numbers by country. Fixed values.
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT",
        26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL", 29: "BR EG PS QA UA", 30: "JO KW MU",
        31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}
LONG_NUMBER = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){6,18}(?![0-9A-Za-z])")


@dataclass(frozen=True)
class PiiParams:
    """Scores: a proposal starts at its kind's score; words within ``window`` code points add ``boost``."""

    window: int = 40
    boost: float = 0.35
    least: float = 0.5
    base: dict[str, float] = field(
        default_factory=lambda: {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.8, "iban": 0.9, "number": 0.3}
    )
    # Lower-case words that speak for a kind. Fixed values.
    words: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "email": ("email", "e-mail", "mail", "contact"),
            "ip": ("ip", "address", "host", "server"),
            "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
            "phone": ("phone", "tel", "call", "mobile", "telefon", "téléphone", "teléfono"),
            "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
            "number": ("ssn", "passport", "account", "phone", "tel", "mobile", "telefon", "konto", "compte", "cuenta"),
        }
    )


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The account number's own check: letters as two digits, the first four signs last."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_PART:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        # What lies before this sign cannot belong to a later address.
        free = found.end() if found else at + 1
        at = text.find("@", free)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        start, parts = run.start(), run.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in four):
                yield start, end
            start = end + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in DIGIT_RUN.finditer(text):
        if run.end() - run.start() >= 16:
            digits = run.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    at = text.find("+")
    while at >= 0:
        tail = PHONE_TAIL.match(text, at + 1)
        end = tail.end()
        if end > at + 1 and "0" <= text[at + 1] <= "9":
            while not "0" <= text[end - 1] <= "9":
                end -= 1
            if end >= at + 4 and 8 <= sum("0" <= c <= "9" for c in text[at:end]) <= 15:
                yield at, end
        at = text.find("+", tail.end())


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """A number has its country's length; of an unlisted country, the longest that ends a word and passes its check.

    Capitals or further numbers behind it do not belong to it; they are read next.
    """
    found = IBAN.search(text)
    while found:
        start, most = found.span()
        # Ends inside the proposal at which no letter or digit follows.
        ends = [e for e in range(most, start + 14, -1) if text[e - 1] != " " and not text[e : e + 1].isalnum()]
        right = IBAN_LENGTHS.get(text[start : start + 2])
        free = start + 4
        for end in ends:
            letters = text[start:end].replace(" ", "")
            if (len(letters) == right if right else 15 <= len(letters) <= 34) and mod97(letters):
                yield start, end
                free = end
                break
        found = IBAN.search(text, free)


def numbers(text: str) -> Iterator[tuple[int, int]]:
    for found in LONG_NUMBER.finditer(text):
        yield found.span()


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "number": numbers}
HAS_DIGIT = re.compile("[0-9]")


def find_spans(text: str, params: PiiParams = PiiParams()) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by kind as listed, then start.

    The four base kinds always stay; their score only tells how sure they are.
    Account numbers need their checksum, loose numbers a word that speaks for
    them; both give way to base spans that they touch.
    """
    out: list[tuple[str, int, int, float]] = []
    digit = HAS_DIGIT.search(text)
    taken = bytearray(len(text) if digit else 0)
    for kind in KINDS:
        if kind != "email" and not digit:
            continue
        if kind == "ip" and text.find(".") < 0:
            continue
        for start, end in FINDERS[kind](text):
            if kind not in BASE_KINDS and taken.find(1, start, end) >= 0:
                continue
            score = params.base[kind]
            around = (
                text[max(0, start - params.window) : start] + " " + text[end : end + params.window]
            ).lower()
            if speaks(around, params.words[kind]):
                score = min(1.0, score + params.boost)
            if kind in BASE_KINDS or score >= params.least:
                out.append((kind, start, end, round(score, 4)))
                if digit:
                    taken[start:end] = b"\x01" * (end - start)
    return out


def speaks(around: str, words: tuple[str, ...]) -> bool:
    return any(w in around and re.search(rf"(?<!\w){re.escape(w)}(?!\w)", around) for w in words)


def redacted(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans as one."""
    out, free = [], 0
    for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= free:
            out += [text[free:start], f"<{kind.upper()}>"]
        free = max(free, end)
    return "".join([*out, text[free:]])


def joined(spans: list[tuple[str, int, int, float]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, _ in spans)


def find_pii(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end, score>>), one row per document.

    A null text counts as empty: no spans. Other columns are ignored; repeated
    rows are answered one by one.
    """
    ready_workers(docs.sparkSession)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "score")
        for batch in (p for whole in batches for p in slices(whole, "text")):
            found = [
                [dict(zip(names, s, strict=True)) for s in find_spans(t.as_py() or "", params)]
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(span))], ["doc_id", "spans"])

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(
        run, "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint, score: double>>"
    )


def pii_digests(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """Counts per base kind, a digest of the base spans, and all spans, per document."""
    found = find_pii(docs, params)

    def listed(spans):
        text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, text), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """The documents with every span in ``text`` replaced, and ``n_chars`` counted anew.

    All other columns, whatever their names, pass unchanged; a null text stays null.
    """
    ready_workers(docs.sparkSession)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch, "text")):
            texts = [
                None if t is None else redacted(t, find_spans(t, params)) for t in (v.as_py() for v in part.column("text"))
            ]
            columns = {c: part.column(c) for c in names}
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                kind = columns["n_chars"].type
                columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(kind)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(run, docs.schema)
