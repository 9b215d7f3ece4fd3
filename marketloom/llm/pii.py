"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns find emails, addresses of machines, payment cards and phone numbers anywhere. The field adds
what needs context: names, numbers and written-out addresses behind words that announce them. It is
trained on a small labelled table (``labelled_table``, or rows of the caller), its features are the shape
classes of the words around a word, and every line is decoded whole by Viterbi in numpy batches.

Defined results
    null or empty text: no spans. Repeated rows: the same spans. Ties between labels: the first of
    ``LABELS``. A span of the field that overlaps a pattern's span is dropped, so those of the patterns
    always stay. Empty table: no rows. Other columns: kept; ``find`` adds ``spans``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone", "name", "id"]
BASE_KINDS = 4
LABELS = ["O", *KINDS]
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match starts at the start of a run of digits, so looking there only changes no match.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern, found from each @ outwards: linear in the text."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > floor and text[start - 1] in LOCAL:
                start -= 1
        if domain and start < at:
            out.append((start, domain.end()))
            floor = domain.end()
        at = text.find("@", max(at + 1, floor))
    return out


def patterns(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns, by start and then kind."""
    out = [("email", *s) for s in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# Words that announce personal data, by what they announce.
CUES = {
    "name": "name named mr mrs ms dr herr frau señor señora monsieur madame signed sincerely",
    "phone": "phone tel telephone mobile fax telefon téléphone teléfono whatsapp",
    "email": "email e-mail mailto correo courriel",
    "card": "card visa mastercard amex",
    "id": "ssn passport iban dni nif passnummer",
    "link": "is no number nr my at dot me número numéro",
}
CUE_OF = {w: k for k, words in CUES.items() for w in words.split()}
ANNOUNCING = {w for w, k in CUE_OF.items() if k != "link"}
CLASSES = ["edge", "small", "capital", "capitals", "mixed", "mark", "digits1", "digits4", "digits7", "digits13", "grouped", "coded", "at", "plus", "colon", *(f"cue_{k}" for k in CUES)]
CLASS = {c: i for i, c in enumerate(CLASSES)}
OFFSETS = (-3, -2, -1, 0, 1, 2)
CHUNK = re.compile(r"[^\s:]+|:")
EDGES = ".,;!?()[]{}\"'<>*#$%&|"
SLAB = 512  # words of a line whose emissions are held at once
CELLS = 1 << 18  # words that are decoded together
LINES = 1 << 12  # lines that are decoded together, at most


def shape(word: str) -> int:
    """The class of a word without the marks around it."""
    low = word.lower()
    if low in CUE_OF:
        return CLASS["cue_" + CUE_OF[low]]
    if word == ":":
        return CLASS["colon"]
    if "@" in word:
        return CLASS["at"]
    digits = 0 if word.isalpha() else sum(c.isdigit() for c in word)
    if word.startswith("+") and digits:
        return CLASS["plus"]
    if digits and digits == len(word):
        return CLASS["digits1" if digits < 4 else "digits4" if digits < 7 else "digits7" if digits < 13 else "digits13"]
    if digits and all(c.isdigit() or c in "-./()" for c in word):
        return CLASS["grouped"]
    if digits:
        return CLASS["coded"]
    if not word.isalpha() and not any(c.isalpha() for c in word):
        return CLASS["mark"]
    if word.islower():
        return CLASS["small"]
    if word.isupper() and len(word) > 1:
        return CLASS["capitals"]
    return CLASS["capital" if word[0].isupper() and word[1:].islower() or len(word) == 1 else "mixed"]


@lru_cache(maxsize=30_000)
def _within(chunk: str) -> tuple[int, int, int]:
    """Where the word of a chunk starts and ends, and its class."""
    word = chunk.strip(EDGES) or chunk
    at = chunk.index(word)
    return at, at + len(word), shape(word)


@lru_cache(maxsize=30_000)
def _class_of(chunk: str) -> int:
    return shape(chunk.strip(EDGES) or chunk)


def chunks(line: str, base: int = 0) -> list[tuple[int, int, int]]:
    """(start, end, class) of each word of a line."""
    out = []
    for m in CHUNK.finditer(line):
        start, end, kind = _within(m[0])
        at = base + m.start()
        out.append((at + start, at + end, kind))
    return out


def labelled_table() -> list[tuple[str, str]]:
    """Small labelled sentences, made by rule: the text, and ``kind`` of each marked word as ``word/kind``."""
    people = ["Ada Lovelace", "Jan Novak", "María García", "Léa Martin", "Otto Weber", "Priya Rao"]
    phones = ["555-0142", "(030) 5550143", "0301 5550144", "5550145678"]
    ids = ["078-05-1120", "X1234567", "DE00123456780000000000", "12345678Z"]
    say = [
        ("My name is {p}", people, "name"), ("Mr {p} wrote this", people, "name"), ("the report , signed {p}", people, "name"),
        ("Frau {p} und andere", people, "name"), ("name : {p}", people, "name"), ("Sincerely , {p}", people, "name"), ("was by Dr {p} .", people, "name"),
        ("phone {p}", phones, "phone"), ("tel : {p}", phones, "phone"), ("my mobile number is {p} please", phones, "phone"), ("Fax no {p}", phones, "phone"),
        ("ssn {p}", ids, "id"), ("passport number {p}", ids, "id"), ("IBAN : {p} and more", ids, "id"), ("my dni is {p}", ids, "id"),
        ("email me at {p}", ["ada at example dot org", "jan.novak at mail dot test"], "email"), ("e-mail : {p}", ["ada at example dot org"], "email"),
        ("card number {p}", ["4000 1234 5678 9017", "4000123456789017"], "card"), ("visa : {p}", ["4000-1234-5678-9017"], "card"),
    ]
    rows = []
    for frame, values, kind in say:
        for value in values:
            marked = " ".join(f"{w}/{kind}" for w in value.split())
            rows.append((frame.format(p=value), frame.format(p=marked)))
    plain = [
        "The of and that is this for", "Is and the named thing was here", "Version 2.0 of the License", "on page 12 at 10 of 2024", "It was no name at all . The end",
        "order 9807915762804490 was shipped", "a total of 12345678 units", "the card is blue", "my phone is broken and old", "call 3 of them", "THE NAME OF THE GAME IS",
        "token = 44c79e8bf7c55759c4958dd60ed83d2ef8cd4e and", "Le nom de la phone est", "In 1999 - 2004 the 3rd one", "see section 4.2.1 and 17", "Licensed under CC BY-NC 4.0.",
        "The email was sent . Then they left", "a passport is needed . Bring it", "number 7 is 42", "at 12.30 on 01.02.2003", "Mr and the others", "by mobile and by fax",
        "to 5927243074273351 the thing", "dot and dash at sea", "name is a word", "what the name means", "Tel Aviv is large", "Visa rules changed in 2019", "me and my number 5",
        "This work is licensed under the GNU General Public License , version 3.", "GNU General Public License 3", "Released under the MIT License 2020",
        "to ada@mail.example Then Next and more", "ada@mail.example Die Stadt und", "a 44c79e8bf7 A. The end and", "Chau. Schein in 441247", "Der Hund. Die Katze 12",
        "The. One was 1999 ago", "10.0.0.1 Das Haus The Tree", "x 4000123456789017 Old Town", "+1 030 5550143 New Road", "New York City 2021", "On Monday Morning 5 of us",
        "is Real Madrid at 9", "at Big Ben 7 is", "12 Monkeys Are Here", "by 3 Old Friends In Town", "5 Things. Many More",
    ]
    return rows + [(p, p) for p in plain]


def _training_rows(rows: list[tuple[str, str]]) -> list[tuple[list[int], list[int]]]:
    out = []
    for text, marked in rows:
        kinds = [w.rsplit("/", 1)[1] if "/" in w else "O" for w in marked.split()]
        starts = [m.start() for m in re.finditer(r"\S+", text)]
        ends = [m.end() for m in re.finditer(r"\S+", text)]
        words = chunks(text)
        labels = [LABELS.index(next(k for a, b, k in zip(starts, ends, kinds) if a <= s < b)) for s, _, _ in words]
        out.append(([c for _, _, c in words], labels))
    return out


class Field:
    """Weights of a shape class at each offset for each label, and of each pair of adjacent labels."""

    def __init__(self, states, steps):
        self.states, self.steps = states, steps

    def emissions(self, classes):
        """classes: sentences by words, with ``edge`` behind the ends."""
        import numpy as np

        left, right = -min(OFFSETS), max(OFFSETS)
        wide = np.pad(classes, ((0, 0), (left, right)))
        n = classes.shape[1]
        return sum(self.states[k][wide[:, left + o : left + o + n]] for k, o in enumerate(OFFSETS))

    def decode(self, classes, lengths):
        """The best labels of each sentence of a padded batch, by Viterbi; emissions are made in overlapping pieces.

        Sentences lie along the last axis, so that each step works on long contiguous rows.
        """
        import numpy as np

        count, n = classes.shape
        left, right = -min(OFFSETS), max(OFFSETS)
        wide = np.pad(classes, ((0, 0), (left, right))).T
        states = [np.ascontiguousarray(w.T) for w in self.states]
        back, best = np.zeros((n, len(LABELS), count), np.int8), None
        for start in range(0, n, SLAB):
            stop = min(n, start + SLAB)
            e = sum(states[k].take(wide[left + o + start : left + o + stop], axis=1) for k, o in enumerate(OFFSETS))
            for t in range(start, stop):
                if best is None:
                    best = e[:, 0].copy()
                    continue
                new, arg = best[0] + self.steps[0][:, None], back[t]
                for y in range(1, len(LABELS)):
                    step = best[y] + self.steps[y][:, None]
                    np.copyto(arg, y, where=step > new)
                    np.maximum(new, step, out=new)
                new += e[:, t - start]
                ended = t >= lengths
                if ended.any():
                    arg[:, ended] = np.arange(len(LABELS))[:, None]
                    new[:, ended] = best[:, ended]
                best = new
        path, every = np.zeros((n, count), np.int8), np.arange(count)
        path[-1] = best.argmax(0)
        for t in range(n - 1, 0, -1):
            path[t - 1] = back[t, path[t], every]
        return path.T


def fit(rows: list[tuple[str, str]] | None = None, rounds: int = 150, rate: float = 0.3, decay: float = 0.002) -> Field:
    """Likelihood ascent on the labelled table, with the gradient from forward and backward sums."""
    import numpy as np

    data = _training_rows(labelled_table() if rows is None else rows)
    longest = max(len(c) for c, _ in data)
    classes, labels = np.zeros((len(data), longest), np.int64), np.zeros((len(data), longest), np.int64)
    mask = np.zeros((len(data), longest), bool)
    for i, (c, y) in enumerate(data):
        classes[i, : len(c)], labels[i, : len(c)], mask[i, : len(c)] = c, y, True
    k = len(LABELS)
    field = Field(np.zeros((len(OFFSETS), len(CLASSES), k)), np.zeros((k, k)))
    left = -min(OFFSETS)
    wide = np.pad(classes, ((0, 0), (left, max(OFFSETS))))
    hot = np.eye(k)[labels] * mask[:, :, None]
    grown = [np.full_like(field.states, 1e-8), np.full_like(field.steps, 1e-8)]

    def sums(x):
        top = x.max(-2, keepdims=True)
        return (np.log(np.exp(x - top).sum(-2, keepdims=True)) + top)[..., 0, :]

    for _ in range(rounds):
        e = field.emissions(classes)
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, longest):
            ahead[:, t] = np.where(mask[:, t, None], sums(ahead[:, t - 1, :, None] + field.steps) + e[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            after = sums((field.steps + (e[:, t + 1] + behind[:, t + 1])[:, None, :]).swapaxes(1, 2))
            behind[:, t] = np.where(mask[:, t + 1, None], after, 0)
        total = sums(ahead[:, -1, :, None])[:, 0]
        each = np.exp(np.minimum(0, ahead + behind - total[:, None, None])) * mask[:, :, None]
        slopes = [-decay * field.states, -decay * field.steps]
        miss = hot - each
        for i, o in enumerate(OFFSETS):
            np.add.at(slopes[0][i], wide[:, left + o : left + o + longest][mask], miss[mask])
        for t in range(1, longest):
            live = mask[:, t]
            pair = ahead[live, t - 1, :, None] + field.steps + (e[live, t] + behind[live, t])[:, None, :] - total[live, None, None]
            slopes[1] += (hot[live, t - 1, :, None] * hot[live, t, None, :] - np.exp(np.minimum(0, pair))).sum(0)
        for weights, slope, g in zip((field.states, field.steps), slopes, grown):
            g += slope**2
            weights += rate * slope / np.sqrt(g)
    return field


def announces(text: str) -> bool:
    """Whether any word of ``chunks`` is announcing or structured."""
    if any(c == "@" or c.isdigit() for c in set(text)):
        return True
    return not ANNOUNCING.isdisjoint(w.strip(EDGES) for w in set(text.lower().replace(":", " ").split()))


def sentences(text: str) -> Iterator[tuple[int, str, list[int]]]:
    """Start, text and the classes of the words of every line that has words."""
    at = 0
    for line in text.split("\n"):
        classes = list(map(_class_of, CHUNK.findall(line)))
        if classes:
            yield at, line, classes
        at += len(line) + 1


def _batches(texts: list[str | None]) -> Iterator[list[tuple[int, int, str, list[int]]]]:
    """Lines of similar length with the number of their text, of about ``CELLS`` words together."""
    held, size = [], 0

    def parts():
        held.sort(key=lambda x: -len(x[3]))
        at = 0
        while at < len(held):
            count = max(1, CELLS // len(held[at][3]))
            yield held[at : at + min(count, LINES)]
            at += min(count, LINES)

    for i, text in enumerate(texts):
        for sentence in sentences(text or ""):
            held.append((i, *sentence))
            size += len(sentence[2])
            if size >= CELLS:
                yield from parts()
                held, size = [], 0
    yield from parts()


def find_in(texts: list[str | None], field: Field) -> list[list[tuple[str, int, int, bool]]]:
    """All spans of each text, by start and then kind."""
    import numpy as np

    found = [[(k, a, b, True) for k, a, b in patterns(t or "")] for t in texts]
    fixed = [[(a, b) for _, a, b, _ in s] for s in found]
    for part in _batches(texts):
        lengths = np.array([len(c) for *_, c in part])
        classes = np.zeros((len(part), lengths.max()), np.int64)
        for j, (*_, c) in enumerate(part):
            classes[j, : len(c)] = c
        paths = field.decode(classes, lengths)
        for j in np.flatnonzero(paths.any(1)):
            (i, base, line, _), path = part[j], paths[j].tolist()
            w, start = chunks(line, base), None
            for t in range(len(w) + 1):
                label = path[t] if t < len(w) else 0
                if start is not None and label != path[start]:
                    a, b = w[start][0], w[t - 1][1]
                    if not any(x < b and a < y for x, y in fixed[i]):
                        found[i].append((LABELS[path[start]], a, b, False))
                    start = None
                if label and start is None:
                    start = t
    return [sorted(s, key=lambda x: (x[1], KINDS.index(x[0]), x[2])) for s in found]


def find(docs: DataFrame, text_col: str = "text", field: Field | None = None) -> DataFrame:
    """The rows with ``spans``: kind, start and end in code points, and whether a pattern found it."""
    model = field or fit()

    @F.pandas_udf(SPANS)
    def run(texts):
        import pandas as pd

        return pd.Series([[{"kind": k, "start": a, "end": b, "base": x} for k, a, b, x in s] for s in find_in(texts.tolist(), model)])

    return docs.withColumn("spans", run(F.col(text_col)))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, with commas between."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", field: Field | None = None) -> DataFrame:
    """The rows with every span replaced by its kind in brackets; of overlapping spans the first one counts."""
    model = field or fit()

    @F.pandas_udf("string")
    def run(texts):
        import pandas as pd

        out = []
        for text, spans in zip(texts.tolist(), find_in(texts.tolist(), model)):
            parts, at = [], 0
            for kind, a, b, _ in spans:
                if b > at:
                    parts += [text[at : max(a, at)], f"[{kind.upper()}]" if a >= at else ""]
                    at = b
            out.append(text if not spans else "".join(parts) + text[at:])
        return pd.Series(out, dtype=object)

    return docs.withColumn(text_col, run(F.col(text_col)))
