"""Personal data by exact base patterns and a semi-Markov conditional random field.

The field scores whole segments of tokens (shape, checksum, length, what stands
before and after), and a dynamic program over segments of bounded length chooses
their boundaries and types together.  Its weights are learnt once, on the driver,
from sentences that this module generates; nothing is downloaded.
"""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import arrow_column

#: Kinds in the order of the spans' listing; the field adds the last three and what the base patterns miss.
KINDS = ("email", "ip", "card", "phone", "national_id", "secret", "iban")
BASE_KINDS = KINDS[:4]
LABELS = ("O", *KINDS)
MAX_TOKENS = 12
#: So many tokens before an entity's first may count for its features.
BEFORE = 4

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_BEFORE = re.compile(r"[A-Za-z0-9._%+-]")
# a run of digits fails from each of its digits if it fails from the first, so only that is tried
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: An entity has a digit or an ``@``, or is what a word for secrets is set to.
_MAYBE = re.compile(r"""[0-9@]|(?i:token|password|passwd|pwd|secret|key)["']?[ \t]*[:=]""")
_SPACE = re.compile(r"\s")
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns, by kind as listed, then start."""
    out = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and _LOCAL_BEFORE.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append(("email", start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


# --- the field -----------------------------------------------------------------------------

_CONTEXT = {
    **dict.fromkeys(("token", "password", "passwd", "secret", "key", "apikey", "pwd"), "secret"),
    **dict.fromkeys(("tel", "phone", "call", "mobile", "fax", "telefon", "tél", "teléfono"), "phone"),
    **dict.fromkeys(("card", "visa", "mastercard", "amex"), "card"),
    **dict.fromkeys(("ssn", "social", "insurance", "passport"), "id"),
    **dict.fromkeys(("iban", "account", "konto"), "iban"),
    **dict.fromkeys(("mail", "email", "contact"), "email"),
    **dict.fromkeys(("version", "v", "page", "section", "no", "order", "year"), "number"),
}
_SHAPES = (
    ("email", re.compile(r"[\w.%+-]+@[\w-]+(\.[\w-]+)+")),
    ("ip", re.compile(r"\d{1,3}(\.\d{1,3}){3}")),
    ("plus_phone", re.compile(r"\+\d{1,3}([ .-]?\(?\d{2,4}\)?){2,4}")),
    ("paren_phone", re.compile(r"\(\d{3}\) ?\d{3}[ .-]\d{4}")),
    ("dash_phone", re.compile(r"\d{3}[-.]\d{3}[-.]\d{4}")),
    ("home_phone", re.compile(r"0\d{1,4}[/-]\d{5,8}|0\d{2,4} \d{5,8}|0\d([ .]\d\d){4}|0\d{2,4} \d{3,4} \d{3,4}")),
    ("ssn", re.compile(r"\d{3}([- ])\d{2}\1\d{4}")),
    ("iban", re.compile(r"[A-Z]{2}\d\d( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,3})?")),
    ("hex", re.compile(r"(?=[0-9a-f]*\d)(?=[0-9a-f]*[a-f])[0-9a-f]{16,}")),
    ("key", re.compile(r"(?=[A-Z0-9]*\d)(?=[A-Z]{2})[A-Z0-9]{16,}")),
    ("mixed_key", re.compile(r"(?=\w*\d)(?=\w*[a-z])(?=\w*[A-Z])([A-Za-z]{2,6}[_-]){0,3}[A-Za-z0-9]{16,}")),
    ("groups", re.compile(r"\d{4}([ -]?\d{4}){2}[ -]?\d{1,7}|\d{13,19}")),
    ("date", re.compile(r"\d{4}-\d{2}-\d{2}|\d{1,2}[./]\d{1,2}[./]\d{2,4}")),
    ("decimal", re.compile(r"\d+\.\d+")),
)
_EDGE = frozenset("+(")
_SIDES = {"": "space", " ": "space", "\t": "space", "\n": "space", '"': "quote", "'": "quote", "`": "quote", **dict.fromkeys(".,;:!?)", "stop"), "=": "set"}


def _iban_sum(span: str) -> bool:
    """ISO 7064: the remainder of the rearranged number is 1."""
    s = span.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


class Sentence:
    """Tokens of a piece of a line, and the segments that may be entities, with their features."""

    def __init__(self, text: str, tokens: list[tuple[int, int]], barred: frozenset[int] = frozenset()):
        self.text, self.tokens, self.barred = text, tokens, barred
        self.words = [text[a:b] for a, b in tokens]
        self.has_digit = [any("0" <= c <= "9" for c in w) for w in self.words]
        self.set_by = [self._set_by(i) for i in range(len(tokens))]
        #: an entity has at least one of these tokens
        self.useful = [d or w == "@" or by is not None for d, w, by in zip(self.has_digit, self.words, self.set_by, strict=True)]

    def _set_by(self, i: int) -> str | None:
        """How a word for secrets is set to what starts at token i (``=`` or ``:``, with a space, with a quote), or null."""
        words, at = self.words, i - 1
        if not words[i][0].isalnum() or at < 1:
            return None
        quoted = words[at] in "\"'"
        at -= quoted
        if at < 1 or words[at] not in "=:":
            return None
        name = at - 1 - (words[at - 1] in "\"'")
        if name < 0 or _CONTEXT.get(words[name].lower()) != "secret":
            return None
        return f"{words[at]}{' ' if self.text[self.tokens[at][1]] in ' \t' else ''}{'q' if quoted else ''}"

    def outside(self, i: int) -> tuple[str, ...]:
        """Features of token i as no part of an entity."""
        w = self.words[i]
        return "o:digits" if self.has_digit[i] else "o:word" if w[0].isalnum() else "o:mark", f"o:long{min(len(w) // 8, 3)}{self.has_digit[i]}"

    def segments(self, i: int) -> list[tuple[int, tuple[str, ...]]]:
        """(end, features) of the entity candidates that start at token i."""
        words, tokens, out = self.words, self.tokens, []
        if i in self.barred or not (words[i][0].isalnum() or words[i] in _EDGE):
            return out
        any_useful, context = False, None
        for j in range(i, min(i + MAX_TOKENS, len(words))):
            if j in self.barred or "\n" in self.text[tokens[j - 1][1] : tokens[j][0]] * (j > i):
                break
            any_useful = any_useful or self.useful[j]
            if any_useful and words[j][0].isalnum():
                span = self.text[tokens[i][0] : tokens[j][1]]
                if j > i and span.count(" ") > 5:
                    break
                context = context or self._context(i)
                out.append((j + 1, self._features(span, i, j, context)))
        return out

    def remembered(self) -> Sentence:
        """The sentence with all its candidates in memory, for training."""
        found = [self.segments(i) for i in range(len(self.tokens))]
        self.segments = found.__getitem__
        return self

    def _context(self, i: int) -> str:
        for w in reversed(self.words[max(0, i - BEFORE + 1) : i]):
            if w.isalpha():
                return _CONTEXT.get(w.lower(), "none")
        return "none"

    def _features(self, span: str, i: int, j: int, context: str) -> tuple[str, ...]:
        alike = span[0] + span[1:].translate(_ABSTRACT) if span[0] == "0" else span.translate(_ABSTRACT)
        shapes, n, _, _ = _span_facts(alike)
        octets = all(int(p) < 256 for p in span.split(".")) if "ip" in shapes else None
        sums = luhn(_digits(span)) if "groups" in shapes and 13 <= n <= 19 else None
        iban = _iban_sum(span) if "iban" in shapes else None
        start, end = self.tokens[i][0], self.tokens[j][1]
        left, after = _SIDES.get(self.text[start - 1 : start], "other"), _SIDES.get(self.text[end : end + 1], "other")
        # a stop that more of the same word follows is no end
        right = "other" if after == "stop" and self.text[end + 1 : end + 2].strip() else after
        return _named(alike, octets, sums, iban, context, left, right, after, self.set_by[i])


@functools.lru_cache(maxsize=1 << 14)
def _named(alike: str, octets: bool | None, sums: bool | None, iban: bool | None, context: str, left: str, right: str, after: str, set_by: str | None) -> tuple[str, ...]:
    """The features of a segment; segments that read alike share them."""
    shapes, _, letter_class, own = _span_facts(alike)
    out = ["bias"]
    for name in shapes or ("none",):
        out.append(f"shape:{name}")
        out.append(f"shape:{name}|context:{context}")
    if octets is not None:
        out.append(f"octets:{octets}")
    out.append(own[0])
    if sums is not None:
        out.append(f"luhn:{sums}")
    if iban is not None:
        out.append(f"iban:{iban}")
    out += own[1:]
    out.append(f"left:{left}")
    out.append(f"right:{right}")
    if set_by is not None:
        out.append(f"set:{set_by}|letters:{letter_class}|spaces:{' ' in alike}")
        out.append(f"set|spaces:{' ' in alike}")
        out.append(f"set|long:{min(len(alike) // 4, 4)}|right:{after}")
    return tuple(out)


#: Characters that no shape tells apart are one: digits but a leading 0, and letters by whether a hex number has them.
_ABSTRACT = {ord(c): stands for cs, stands in (("0123456789", "1"), ("abcdef", "a"), ("ghijklmnopqrstuvwxyz", "z"), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A")) for c in cs}


@functools.lru_cache(maxsize=1 << 14)
def _span_facts(span: str) -> tuple[tuple[str, ...], int, str, tuple[str, ...]]:
    """Shapes, number of digits, kind of letters and features of an abstract span; all spans that read alike share them."""
    shapes = tuple(name for name, pattern in _SHAPES if pattern.fullmatch(span))
    n, letters = len(_digits(span)), sum(c.isalpha() for c in span)
    letter_class = "none" if not letters else "all" if letters == len(span) else "some"
    own = [f"digits:{0 if not n else '1-8' if n < 9 else '9-12' if n < 13 else '13-15' if n < 16 else '16-19' if n < 20 else 'more'}", f"letters:{letter_class}"]
    if "(" in span or ")" in span:
        own.append(f"brackets:{span.count('(') == span.count(')')}")
    return shapes, n, letter_class, tuple(own)


def _score(weights, features, label: str) -> float:
    return sum(weights.get((f, label), 0.0) for f in features)


def _arcs(s: Sentence, weights, i: int) -> list[tuple[int, str, float]]:
    """The segments that start at token i: (end, label, score)."""
    arcs = [(i + 1, "O", _score(weights, s.outside(i), "O"))]
    arcs += [(end, k, _score(weights, f, k)) for end, f in s.segments(i) for k in KINDS]
    return arcs


class Scores:
    """Fixed weights, with the scores of sets of features that were seen: texts have far fewer of these than segments."""

    def __init__(self, weights, most: int = 1 << 14):
        self.weights, self.most, self.known = weights, most, {}
        self.steps = {label: {p: weights.get((p, label), 0.0) for p in ("^", "O", *KINDS)} for label in ("O", *KINDS)}

    def of(self, features: tuple[str, ...], labels: tuple[str, ...]) -> tuple[float, ...]:
        found = self.known.get(features)
        if found is None:
            if len(self.known) >= self.most:
                self.known.clear()
            found = self.known[features] = tuple(_score(self.weights, features, k) for k in labels)
        return found


_OUTSIDE = ("O",)


def decode(s: Sentence, weights) -> list[tuple[str, int, int]]:
    """The best segmentation's entities as (kind, first token, end token).

    Candidates are made token by token; of a token only the best way to each label is
    kept, so memory grows with the tokens, not with their segments.
    """
    scores = weights if isinstance(weights, Scores) else Scores(weights)
    n = len(s.tokens)
    best: list[dict[str, tuple[float, int, str]]] = [{} for _ in range(n + 1)]
    best[0]["^"] = (0.0, -1, "")

    def into(here: dict, label: str) -> tuple[float, str]:
        """The best way to a segment of a label that starts here: score and the label before."""
        step = scores.steps[label]
        if len(here) == 1:
            ((p, (v, _, _)),) = here.items()
            return v + step[p], p
        return max([(v + step[p], p) for p, (v, _, _) in here.items()])

    for i in range(n):
        here = best[i]
        if not here:
            continue
        value, before = into(here, "O")
        value += scores.of(s.outside(i), _OUTSIDE)[0]
        if "O" not in best[i + 1] or value > best[i + 1]["O"][0]:
            best[i + 1]["O"] = (value, i, before)
        ways = None
        for end, features in s.segments(i):
            ways = ways or [(k, *into(here, k)) for k in KINDS]
            there = best[end]
            for (k, value, before), score in zip(ways, scores.of(features, KINDS), strict=True):
                if k not in there or value + score > there[k][0]:
                    there[k] = (value + score, i, before)
    out, at = [], n
    label = max(best[n], key=lambda k: best[n][k][0]) if n else "^"
    while at > 0:
        _, start, before = best[at][label]
        if label != "O":
            out.append((label, start, at))
        at, label = start, before
    return out[::-1]


def _log_sum(values: list[float]) -> float:
    m = max(values)
    return m + math.log(sum(math.exp(v - m) for v in values))


def _gradient(s: Sentence, gold: list[tuple[str, int, int]], weights) -> dict:
    """Observed less expected feature counts, by the forward-backward recursion over segments."""
    n = len(s.tokens)
    arcs = [_arcs(s, weights, i) for i in range(n)]
    forward: list[dict[str, float]] = [{} for _ in range(n + 1)]
    forward[0]["^"] = 0.0
    steps: list[tuple[int, int, str, str, float]] = []
    incoming: list[dict[str, list[float]]] = [defaultdict(list) for _ in range(n + 1)]
    for i in range(n):
        if i:
            forward[i] = {k: _log_sum(v) for k, v in incoming[i].items()}
        for end, label, score in arcs[i]:
            for before, v in forward[i].items():
                x = score + weights.get((before, label), 0.0)
                steps.append((i, end, before, label, x))
                incoming[end][label].append(v + x)
    forward[n] = {k: _log_sum(v) for k, v in incoming[n].items()}
    backward: list[dict[str, list[float]]] = [defaultdict(list) for _ in range(n + 1)]
    z = _log_sum(list(forward[n].values()))
    back: list[dict[str, float]] = [{} for _ in range(n + 1)]
    back[n] = dict.fromkeys(forward[n], 0.0)
    by_start: dict[int, list] = defaultdict(list)
    for step in steps:
        by_start[step[0]].append(step)
    out: dict = defaultdict(float)
    features = {(i, end): f for i in range(n) for end, f in s.segments(i)}
    for i in range(n - 1, -1, -1):
        for _, end, before, label, x in by_start[i]:
            if label not in back[end]:
                continue
            tail = x + back[end][label]
            backward[i][before].append(tail)
            p = math.exp(forward[i][before] + tail - z)
            if p > 1e-9:
                out[(before, label)] -= p
                for f in s.outside(i) if label == "O" else features[(i, end)]:
                    out[(f, label)] -= p
        back[i] = {k: _log_sum(v) for k, v in backward[i].items()}
    at, before, spans = 0, "^", {a: (k, b) for k, a, b in gold}
    while at < n:
        label, end = spans.get(at, ("O", at + 1))
        out[(before, label)] += 1
        for f in s.outside(at) if label == "O" else features[(at, end)]:
            out[(f, label)] += 1
        at, before = end, label
    return out


def _example(rng: random.Random) -> tuple[str, list[tuple[str, int, int]]]:
    """A generated sentence and its entities as character spans."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice(("an", "ter", "on", "lo", "mi", "su", "ex", "pra", "the", "ing")) for _ in range(rng.randint(1, 3)))

    def card() -> str:
        while not luhn(c := rng.choice("345") + digits(rng.choice((14, 15, 15)))):
            pass
        return c if rng.random() < 0.6 else " ".join(c[i : i + 4] for i in range(0, len(c), 4))

    def iban() -> str:
        country, rest = rng.choice("ABDEFGHIPST") + rng.choice("BEKLRST"), digits(rng.choice((12, 16, 18, 20)))
        found = country + f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}" + rest
        return found if rng.random() < 0.4 else " ".join(found[i : i + 4] for i in range(0, len(found), 4))

    def chosen() -> str:
        """What people choose as passwords."""
        return rng.choice(("", "!", "&", "#")).join([word().capitalize(), rng.choice((word(), digits(rng.randint(1, 4))))]) + rng.choice(("", digits(2), word()))

    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n - 2)) + "a7"
    entity = {
        "email": lambda: f"{word()}{rng.choice(('', '.', '_'))}{digits(2)}@{word()}.{rng.choice(('com', 'org', 'example.com'))}",
        "ip": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)),
        "card": card,
        "phone": lambda: rng.choice((f"+{rng.randint(1, 99)} ({digits(3)}) {digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"+{digits(2)} {digits(3)} {digits(4)}",
                                     f"0{digits(rng.randint(2, 4))}{rng.choice('/- ')}{digits(rng.randint(6, 8))}", f"0{digits(1)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}", f"0{digits(2)} {digits(4)} {digits(4)}")),
        "national_id": lambda: rng.choice(("{}-{}-{}", "{} {} {}")).format(digits(3), digits(2), digits(4)),
        "secret": lambda: rng.choice((hexes(rng.choice((18, 32, 40))), "AK" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ23456789") for _ in range(17)) + "7", rng.choice(("", "tk_", "live-key-")) + "".join(rng.choice("abcdefgXYZQRST0123456789") for _ in range(rng.randint(18, 36))) + "aZ4")),
        "iban": iban,
    }
    before = {"secret": ("token =", "password=", "key:", ""), "phone": ("call", "tel", ""), "card": ("card", "visa", ""), "national_id": ("ssn", ""), "email": ("mail", "contact", ""), "ip": ("",), "iban": ("iban", "account", "")}
    plain = (lambda: digits(rng.randint(1, 6)), lambda: f"version {rng.randint(1, 9)}.{rng.randint(0, 9)}", lambda: f"{rng.randint(1900, 2030)}", lambda: f"{rng.randint(1900, 2030)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}",
             lambda: f"order {digits(rng.choice((8, 10, 12)))}", lambda: f"{digits(2)}.{digits(2)}.{rng.randint(1990, 2030)}", lambda: f"{rng.randint(300, 999)}.{digits(3)}.{digits(3)}.{rng.randint(300, 999)}", lambda: word() + digits(2), lambda: f"{digits(1)}, {digits(2)} {word()} {digits(3)}",
             lambda: f"{rng.choice(('key', 'secret', 'token', 'password'))}: {word()} {word()} {word()}", lambda: f"{rng.choice(('key', 'token'))} {word()} {digits(2)}", lambda: f"{digits(2)} {digits(2)} {digits(2)}", lambda: f"{digits(2)}:{digits(2)}", lambda: f"{digits(3)} {digits(3)} {digits(3)}", lambda: f"{digits(4)} {digits(4)}", lambda: f"{word()}_{word()}{digits(1)}")
    text, spans = word() if rng.random() < 0.7 else "", []
    for _ in range(rng.randint(1, 4)):
        if text:
            text += rng.choice((" ", ", ", ". ")) + " ".join(word() for _ in range(rng.randint(0, 4)))
            text = text if text.endswith(" ") else text + " "
        chance = rng.random()
        if chance < 0.1:
            quote = rng.choice(("", '"', "'"))
            text += rng.choice(("password", "secret", "pwd", "token")) + rng.choice(("=", " = ", ":", ": ")) + quote
            e = chosen()
            spans.append(("secret", len(text), len(text) + len(e)))
            text += e + quote
        elif chance < 0.65:
            kind = rng.choice(KINDS)
            lead = rng.choice(before[kind])
            quote = '"' if lead.endswith("=") and rng.random() < 0.5 else ""
            text += lead + (" " if lead and not lead.endswith("=") else "") + quote
            e = entity[kind]()
            spans.append((kind, len(text), len(text) + len(e)))
            text += e + quote
            if rng.random() < 0.3:  # two entities with only a space between them
                kind = rng.choice(("card", "ip", "email"))
                e = entity[kind]()
                spans.append((kind, len(text) + 1, len(text) + 1 + len(e)))
                text += f" {e}"
        else:
            text += rng.choice(plain)()
    return text + rng.choice((".", "", f" {word()}.")), spans


def tokens_of(text: str, start: int = 0, end: int | None = None) -> list[tuple[int, int]]:
    return [m.span() for m in _TOKEN.finditer(text, start, len(text) if end is None else end)]


@functools.lru_cache(maxsize=4)
def trained(examples: int = 500, epochs: int = 5, seed: int = 17) -> dict:
    """Weights that maximise the conditional likelihood of generated sentences, by stochastic gradient steps."""
    rng, weights, data = random.Random(seed), {}, []
    while len(data) < examples:
        text, spans = _example(rng)
        s = Sentence(text, tokens_of(text)).remembered()
        first, last = {a: i for i, (a, _) in enumerate(s.tokens)}, {b: i + 1 for i, (_, b) in enumerate(s.tokens)}
        gold = [(k, first.get(a), last.get(b)) for k, a, b in spans]
        if all(a is not None and b is not None and any(end == b for end, _ in s.segments(a)) for _, a, b in gold):
            data.append((s, gold))
    for epoch in range(epochs):
        rate = 0.5 / (1 + epoch)
        for s, gold in data:
            for key, g in _gradient(s, gold, weights).items():
                weights[key] = weights.get(key, 0.0) + rate * g
    return {k: round(v, 6) for k, v in weights.items() if abs(v) > 1e-4}


def _covered(tokens: list[tuple[int, int]], spans: list[tuple[int, int]], at: int) -> set[int]:
    """Numbers of the tokens that meet one of the spans from number ``at`` on; both sorted by start."""
    out, open_ = set(), 0
    for i, (a, b) in enumerate(tokens):
        while at < len(spans) and spans[at][0] < b:
            open_, at = max(open_, spans[at][1]), at + 1
        if a < open_:
            out.add(i)
    return out


#: Triggers with more tokens than this between them are decoded apart.
GAP = 2 * (MAX_TOKENS + BEFORE) + 4


def _low(text: str, at: int, start: int) -> int:
    """Where the ``MAX_TOKENS + BEFORE + 1`` tokens before a position begin, or the line's ``start``."""
    reach, need = 200, MAX_TOKENS + BEFORE + 1
    while at - reach > start:
        # a space is in no token, so the tokens after it are the line's
        if space := _SPACE.search(text, at - reach, at):
            tokens = tokens_of(text, space.end(), at)
            if len(tokens) >= need:
                return tokens[-need][0]
        reach *= 2
    return start


def _stretches(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """The parts of a line that triggers can have entities in, with tokens on both sides that no entity reaches."""
    low = high = None
    for m in _MAYBE.finditer(text, start, end):
        if low is not None and m.start() - high > GAP and sum(1 for _ in islice(_TOKEN.finditer(text, high, m.start()), GAP + 1)) > GAP:
            yield low, max([high, *(t.end() for t in islice(_TOKEN.finditer(text, high, end), MAX_TOKENS + BEFORE))])
            low = None
        low, high = _low(text, m.start(), start) if low is None else low, m.end()
    if low is not None:
        yield low, max([high, *(t.end() for t in islice(_TOKEN.finditer(text, high, end), MAX_TOKENS + BEFORE))])


def field_spans(text: str, weights, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The field's spans outside the base ones, line by line: an entity doesn't cross a line's end.

    Only stretches near triggers are decoded: no segment without a useful token can be
    an entity, and each stretch begins with tokens that no segment reaches (or with the
    line), so the result is that of decoding the line whole.
    """
    out, at, covered, first = [], 0, sorted((a, b) for _, a, b in base), 0
    while m := _MAYBE.search(text, at):
        start, at = text.rfind("\n", 0, m.start()) + 1, text.find("\n", m.start())
        at = len(text) if at < 0 else at
        for low, high in _stretches(text, start, at):
            while first < len(covered) and covered[first][1] <= low:
                first += 1
            part = tokens_of(text, low, high)
            for k, i, j in decode(Sentence(text, part, frozenset(_covered(part, covered, first))), weights):
                out.append((k, part[i][0], part[j - 1][1]))
    return out


def find_spans(text: str | None, weights) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans, both by kind as listed, then start."""
    if not text or not _MAYBE.search(text):
        return [], []
    base = base_spans(text)
    return base, sorted(base + field_spans(text, weights, base), key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


FOUND = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in BASE_KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
)


def detect(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: counts of base spans, their digest, and all spans as text.

    A null or empty text has no spans.  Repeated rows give repeated results.  Base
    spans of different kinds may overlap; the field's overlap nothing.  Texts of any
    length are decoded whole, line by line.  Each row is handled where it is read.
    """
    weights = Scores(trained())

    def one(text):
        base, spans = find_spans(text, weights)
        counts = {f"n_{k}": sum(s[0] == k for s in base) for k in BASE_KINDS}
        return counts | {"base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined(spans)}

    column = arrow_column(lambda texts: [one(t) for t in texts], FOUND, F.col("text").cast("string")).alias("p")
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("id"), column).select(*(F.col("id")[c].alias(c) for c in keep), "p.*")


def redact_text(text: str | None, weights) -> str | None:
    """The text with each span (merged where they overlap) replaced by its kind in brackets."""
    if text is None:
        return None
    merged: list[list] = []
    for kind, a, b in sorted(find_spans(text, weights)[1], key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    out, at = [], 0
    for kind, a, b in merged:
        out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def redacted(text: Column) -> Column:
    """A column with personal data replaced; null stays null."""
    weights = Scores(trained())
    return arrow_column(lambda texts: [redact_text(t, weights) for t in texts], T.StringType(), text.cast("string"))
