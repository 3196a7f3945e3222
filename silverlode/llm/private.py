"""Personal data: fixed patterns plus a linear-chain conditional random field.

The patterns give the base spans. The field labels what is written like personal data but
misses a pattern (a phone number without its plus sign, numbers in other groupings, an
address with a bracketed "at"). It reads words as shapes: runs of digits by length, of
letters and of marks as one sign. It is trained on a small labelled table and decodes with
Viterbi, many lines at a time. Only words with a digit or an at-sign, and those beside a
bracketed "at", may carry a label, so a line without one needs no decoding: its best path
is all outside. What the field calls a phone is none if it holds a calendar date or a time
of day; eight digits that read as a date are taken for one.

NULL and empty texts hold no spans; texts of any length are read whole, line by line.
Added spans never overlap base spans; of equal paths the one with the earlier label in
``LABELS`` is taken. Repeated rows stay, an empty table gives an empty table, other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm.common import picked, texts_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# a digit run that fails from its start fails from inside, so matches begin at run starts
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the e-mail pattern, in time linear in the text: every match holds one at-sign."""
    out, after, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > after and text[lo - 1] in LOCAL_CHARS:
            lo -= 1
        m = DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append((lo, m.end()))
        after = m.end() if m else at + 1
        at = text.find("@", after)
    return out


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the fixed patterns by kind, in code points, end exclusive."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if not DIGITS.search(text):
        return out
    out["ip"] = [m.span() for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        if len(m.group()) >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in PHONE.finditer(text) if 8 <= sum(map(str.isdigit, m.group())) <= 15]
    return out


# --- the field -----------------------------------------------------------------------

WORD = re.compile(r"\S+")
RUNS = re.compile(r"[0-9]+|[a-z]+|[A-Z]+|[^\x00-\x7F]+|(.)\1*", re.S)
EDGES = "\"'`,;:!?#$%&*<>[]{}|."


#: A bracketed "at", and a word that is a calendar date (year, month and day in the usual orders), maybe with a time.
AT = re.compile(r"[(\[{]at[)\]}]", re.I)
WRITTEN_AT = re.compile(r"[\w.%+-]+ ?[(\[{]at[)\]}] ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.I)
_YEAR, _MONTH, _DAY = "(?:19|20)[0-9]{2}", "(?:0?[1-9]|1[0-2])", "(?:0?[1-9]|[12][0-9]|3[01])"
DATE = re.compile(
    rf"(?:{_YEAR}([-./]){_MONTH}\1{_DAY}|{_YEAR}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])|{_DAY}([-./]){_MONTH}\2{_YEAR}|{_MONTH}([-./]){_DAY}\3{_YEAR})"
    r"(?:[T_-]?[0-2][0-9]:?[0-5][0-9](?::?[0-5][0-9])?(?:[.][0-9]+)?Z?)?"
)
TIME = re.compile(r"[0-9]:[0-9]")


def dated(word: str) -> bool:
    return bool(DATE.fullmatch(word.strip(EDGES)))


def shape(word: str) -> str:
    """Runs of digits by length up to twelve, runs of letters and repeated marks as one sign."""

    def one(m: re.Match) -> str:
        s = m.group()
        c = s[0]
        if "0" <= c <= "9":
            return f"9{min(len(s), 12)}"
        if "a" <= c <= "z":
            return "x"
        if "A" <= c <= "Z":
            return "X"
        return c if c < "\x80" else "u"

    return RUNS.sub(one, word)


def features(words: list[str]) -> list[list[str]]:
    shapes = [shape(w.strip(EDGES)) for w in words]
    around = ["<", *shapes, ">"]
    out = []
    for i, (w, s) in enumerate(zip(words, shapes, strict=True)):
        digits = min(sum(map(str.isdigit, w)), 20)
        out.append([f"s={s}", f"p={around[i]}|{s}", f"n={s}|{around[i + 2]}", f"d={digits}", f"@={'@' in w}", f"+={w[:1] == '+'}", f"l={sum(map(str.isalpha, w)) > 0}", f"a={bool(AT.search(w))}", f"t={dated(w)}"])
    return out


def carriers(words: list[str]) -> list[bool]:
    """Which words may carry a label."""
    own = ["@" in w or bool(DIGITS.search(w) or AT.search(w)) for w in words]
    alone = [bool(AT.fullmatch(w)) for w in words]
    return [c or any(alone[max(0, i - 1) : i + 2]) for i, c in enumerate(own)]


class Field:
    """Weights of features by label and of label pairs."""

    def __init__(self, names: dict[str, int], emit: np.ndarray, move: np.ndarray):
        self.names, self.emit, self.move = names, emit, move

    def scores(self, words: list[str]) -> np.ndarray:
        s = np.zeros((len(words), len(LABELS)))
        for i, (f, may) in enumerate(zip(features(words), carriers(words), strict=True)):
            for x in f:
                k = self.names.get(x)
                if k is not None:
                    s[i] += self.emit[k]
            if not may:
                s[i, 1:] = -1e9
        return s

    def decode(self, lines: list[list[str]]) -> list[np.ndarray]:
        """Viterbi over many lines at once, padded to the longest of similar length."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(lines)
        order = sorted(range(len(lines)), key=lambda i: len(lines[i]))
        for at in range(0, len(order), 256):
            some = [i for i in order[at : at + 256] if lines[i]]
            if not some:
                continue
            own = [self.scores(lines[i]) for i in some]
            t = max(map(len, own))
            s = np.zeros((len(some), t, len(LABELS)))
            s[:, :, 1:] = -1e9  # past the end only outside
            for j, x in enumerate(own):
                s[j, : len(x)] = x
            best, back = s[:, 0], np.zeros((len(some), t, len(LABELS)), np.int8)
            for k in range(1, t):
                step = best[:, :, None] + self.move
                back[:, k] = step.argmax(1)
                best = step.max(1) + s[:, k]
            path = np.zeros((len(some), t), np.int8)
            path[:, -1] = best.argmax(1)
            for k in range(t - 1, 0, -1):
                path[:, k - 1] = np.take_along_axis(back[:, k], path[:, k, None], 1)[:, 0]
            for j, i in enumerate(some):
                out[i] = path[j, : len(own[j])]
        return out


def train(rows: list[tuple[list[str], list[int]]], rounds: int = 120, rate: float = 0.5, ridge: float = 1e-3) -> Field:
    """Maximum likelihood by gradient ascent (AdaGrad) on a small table of labelled lines."""
    names: dict[str, int] = {}
    data = []
    for words, labels in rows:
        ids = [[names.setdefault(x, len(names)) for x in f] for f in features(words)]
        data.append((np.array(ids), np.array(labels), ~np.array(carriers(words))))
    k = len(LABELS)
    emit, move = np.zeros((len(names), k)), np.zeros((k, k))
    seen_e, seen_m = np.full_like(emit, 1e-6), np.full_like(move, 1e-6)
    for _ in range(rounds):
        ge, gm = -ridge * emit, -ridge * move
        for ids, y, barred in data:
            s = emit[ids].sum(1)
            s[barred, 1:] = -1e9
            n = len(y)
            fwd, bwd = np.zeros((n, k)), np.zeros((n, k))
            fwd[0] = s[0]
            for i in range(1, n):
                x = fwd[i - 1][:, None] + move
                top = x.max(0)
                fwd[i] = s[i] + top + np.log(np.exp(x - top).sum(0))
            for i in range(n - 2, -1, -1):
                x = move + s[i + 1] + bwd[i + 1]
                top = x.max(1, keepdims=True)
                bwd[i] = top[:, 0] + np.log(np.exp(x - top).sum(1))
            z = fwd[-1].max() + np.log(np.exp(fwd[-1] - fwd[-1].max()).sum())
            miss = -np.exp(fwd + bwd - z)
            miss[np.arange(n), y] += 1
            for j in range(ids.shape[1]):
                np.add.at(ge, ids[:, j], miss)
            for i in range(1, n):
                gm -= np.exp(fwd[i - 1][:, None] + move + s[i] + bwd[i] - z)
                gm[y[i - 1], y[i]] += 1
        seen_e += ge**2
        seen_m += gm**2
        emit += rate * ge / np.sqrt(seen_e)
        move += rate * gm / np.sqrt(seen_m)
    return Field(names, emit, move)


#: The labelled table: lines whose words carry "word/kind" where a kind applies.
LABELLED = """
call +44/phone (20)/phone 7946-0958/phone today
her number is +1/phone (212)/phone 555-0147/phone thanks
phone 212-555-0188/phone or mail jo.doe@mail.example.com/email
reach me under 020/phone 7946/phone 0018/phone in the evening
tel 555-867-5309/phone
tel. (415)/phone 555-2671/phone please
fax +49/phone 30/phone 901820/phone
mail to anna@example.org/email and wait
anna.b@site1.example.net/email wrote on 12.05.2021 again
write ben@mail.example.com/email by 17:30
host 10.0.0.12/ip answered in 12 ms
from 192.168.1.254/ip port 8080
address 172.16.31.7/ip was blocked
card 4111/card 1111/card 1111/card 1111/card expires 12/27
paid with 5500-0000-0000-0004/card yesterday
card number 4012888888881881/card was used
in 2019 there were 312 cases and 44 more in 2020
chapter 3 of 12 pages 100 to 120
version 2.0 and version 3.1.4 are out
the year 1984 and the year 2001
price 12.99 for 3 pieces
on 2021-05-12 at 10:45 we met
order 123456 was sent
token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
key = "9f1c2d3e4b5a69788796a5b4c3d2e1f0" set
id 0d3f2a1b 77 e8 and hash 5e884898da28047151d0e56f8dc62927
licensed under version 3 of 2007 and CC BY-NC 4.0.
room 12 floor 3 house 44
10. first 11. second 12. third
about 50% of 1,000,000 rows
6011000990139424 6011000990139425 4716
backup 20210512 and 20191231 done
backup 2021-05-12 10:45 ok
log 13.05.2022 08:00:01 started
from 01/02/2003 to 31/12/2004 open
due 2020-01-31
20230704 report
born 07.11.1985 in 1985
updated 2022-11-30T10:15:00 by 12
invoice 2019-004512 of 03.04.2019
isbn 978-3-16-148410-0 page 12
article 10045321 weighs 300 g
id 7700123456 and id 88001234
population 83020000 in 2019
phone 0151-23456789/phone home
ring 415.555.2671/phone at noon
my number 030/phone 1234567/phone works
call 07700/phone 900123/phone first
dial 02079460958/phone now
mobile 5558675309/phone only
mail jo.doe(at)mail.example.com/email soon
write to anna[at]example.org/email or ben{at}example.net/email
contact ben/email (at)/email example.org/email directly
reach jo/email [at]/email mail.example.net/email please
we met (at) noon in 2020
""".strip()


def labelled_rows(table: str = LABELLED) -> list[tuple[list[str], list[int]]]:
    rows = []
    for line in table.splitlines():
        words, labels = [], []
        for w in line.split():
            word, _, kind = w.rpartition("/")
            known = kind in KINDS
            words.append(word if known else w)
            labels.append(LABELS.index(kind) if known else 0)
        rows.append((words, labels))
    return rows


def marked_lines(text: str) -> Iterator[tuple[int, str]]:
    """Start and text of each line with a digit, an at-sign or a bracketed "at", each line once."""
    after = 0
    for m in re.finditer(r"[0-9@]|(?i:[(\[{]at[)\]}])", text):
        if m.start() < after:
            continue
        lo = text.rfind("\n", after, m.start()) + 1 or after
        hi = text.find("\n", m.start())
        after = len(text) if hi < 0 else hi + 1
        yield lo, text[lo : len(text) if hi < 0 else hi]


WINDOW = 12  # words kept on either side of a word that may carry a label


def plausible(kind: str, raw: str) -> bool:
    """What the kind's own arithmetic says: the field proposes, check digits and counts decide."""
    digits = "".join(c for c in raw if "0" <= c <= "9")
    if kind == "email":
        return "@" in raw or bool(WRITTEN_AT.search(raw))
    if any(map(str.isalpha, raw)):
        return False
    if kind == "phone" and (TIME.search(raw) or any(map(dated, raw.split()))):
        return False
    return {"ip": raw.count(".") >= 3, "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def added_spans(field: Field, texts: list[str], base: list[dict]) -> list[list[tuple[str, int, int]]]:
    """What the field finds beside the base spans: words of one kind in a row, without edge marks."""
    lines, places = [], []
    for d, text in enumerate(texts):
        for at, line in marked_lines(text):
            words = [(m.group(), at + m.start()) for m in WORD.finditer(line)]
            can = np.flatnonzero(carriers([w for w, _ in words])).tolist()
            # words farther off than the window are outside and change no label: cut there
            cuts: list[list[int]] = []
            for i in can:
                if cuts and i - cuts[-1][1] <= 2 * WINDOW:
                    cuts[-1][1] = i
                else:
                    cuts.append([i, i])
            for lo, hi in cuts:
                part = words[max(0, lo - WINDOW) : hi + WINDOW + 1]
                lines.append([w for w, _ in part])
                places.append((d, [p for _, p in part]))
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for words, (d, at), path in zip(lines, places, field.decode(lines), strict=True):
        i = 0
        while i < len(words):
            j = i
            while j + 1 < len(words) and path[j + 1] == path[i] and path[i]:
                j += 1
            if path[i]:
                kind = LABELS[path[i]]
                raw = texts[d][at[i] : at[j] + len(words[j])]
                lo = at[i] + len(raw) - len(raw.lstrip(EDGES))
                hi = at[i] + len(raw.rstrip(EDGES))
                if lo < hi and plausible(kind, raw) and not any(a < hi and lo < b for spans in base[d].values() for a, b in spans):
                    out[d].append((kind, lo, hi))
            i = j + 1
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1], s[2])))


def find_private(df: DataFrame, key: str = "doc_id", text: str = "text", field: Field | None = None) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and digest cover the base spans; ``spans`` lists all, as kind:start:end. NULL
    counts as the empty text: no spans. Repeated rows stay.
    """
    shared = df.sparkSession.sparkContext.broadcast(field or train(labelled_rows()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = texts_of(b)
            base = [base_spans(t) for t in texts]
            more = added_spans(shared.value, texts, base)
            flat = [[(k, *s) for k in KINDS for s in x[k]] for x in base]
            yield pa.RecordBatch.from_arrays(
                [b.column(0)]
                + [pa.array([len(x[k]) for x in base], pa.int64()) for k in KINDS]
                + [pa.array([hashlib.sha256(written(x).encode()).hexdigest() for x in flat]), pa.array([written(x + y) for x, y in zip(flat, more, strict=True)], pa.string())],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
            )

    return picked(df, doc_id=key, text=text).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(df: DataFrame, text: str = "text", field: Field | None = None) -> DataFrame:
    """``df`` with every found span of ``text`` replaced by its kind in angle brackets.

    Overlapping spans become one, under the kind that starts first. NULL stays NULL; all
    other columns stay as they are.
    """
    spark: SparkSession = df.sparkSession
    shared = spark.sparkContext.broadcast(field or train(labelled_rows()))

    @F.pandas_udf("string")
    def mask(column):
        texts = [t or "" for t in column]
        base = [base_spans(t) for t in texts]
        more = added_spans(shared.value, texts, base)
        out = []
        for raw, t, x, y in zip(column, texts, base, more, strict=True):
            parts, at = [], 0
            for a, b, k in sorted([(a, b, k) for k in KINDS for a, b in x[k]] + [(a, b, k) for k, a, b in y]):
                if a >= at:
                    parts += [t[at:a], f"<{k}>"]
                at = max(at, b)
            out.append(None if raw is None else "".join(parts) + t[at:])
        import pandas as pd

        return pd.Series(out, dtype=object)

    return df.withColumn(text, mask(F.col(f"`{text}`")))
