"""Personal data in texts: exact patterns, and a linear-chain CRF for what has no pattern.

Patterns find e-mail addresses, IP addresses, payment cards and phone numbers.  A
conditional random field over words adds people's names, national identity numbers and
secrets (passwords, keys, tokens), which are told by shape and neighbours.  Its features
are a word's shape, affixes and the shapes of the words beside it; weights come from a
small labelled table that ``labelled_lines`` builds from templates.  All words of a text
are labelled: emissions are sums of per-word rows, and Viterbi runs in numpy over
batches of lines of like length.  A line that a batch of texts repeats is decoded once, and a
line is not decoded where no word's best score, with the best transitions around it, comes up to
that of staying outside all spans: there the best path is known to have none.

A span of the CRF that touches a pattern's span is dropped, patterns' spans stay.
Null texts are empty and have no spans; repeated rows are judged each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rollbook.llm.arrowtext import release, slices, texts

BASE = ("email", "ip", "card", "phone")
ADDED = ("person", "identity", "secret")
ORDER = {kind: k for k, kind in enumerate((*BASE, *ADDED))}

# ---------------------------------------------------------------- patterns

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A digit before the start means that the same run of digits failed from its beginning.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Found from the at sign, so that a long run of letters is read once."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        if domain and start < at:
            found.append((start, domain.end()))
            free = domain.end()
        else:
            free = at + 1  # no match reaches over this at sign
        at = text.find("@", free)
    return found


LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Leftmost matches of each kind that do not overlap one another; failing ones are dropped."""
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = NOT_DIGIT.sub("", m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], ORDER[s[2]]))


# ---------------------------------------------------------------- features

#: Words that announce one of the added kinds. Fixed values.
CUES = {
    "title": ("mr", "mrs", "ms", "dr", "prof", "herr", "frau", "madame", "monsieur", "señor", "señora"),
    "name": ("name", "signed", "sincerely", "patient", "customer"),
    "is": ("is", "ist", "est", "es"),
    "number": ("ssn", "security", "passport", "identity", "insurance", "nino", "dni"),
    "secret": ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "key", "pin"),
}
CUE = {word: group for group, words_ in CUES.items() for word in words_}
#: Where a word stands as seen from the one that its features score.
SIDES = {"self": 0, "before": -1, "before2": -2, "after": 1}
#: A word without the marks around it; what stands before an equals sign is a mark too.
CORE = re.compile(r"(?:\w+[=:])?[\W_]*(.*?)[\W_]*\Z", re.S)


def shape(word: str) -> str:
    """Letters X, x and digits 9, each at most twice in a row: 'Xxx' for 'Hello', '99-99' for '123-45'."""
    out: list[str] = []
    for c in word[:24]:
        s = "9" if c.isdigit() else "X" if c.isupper() else "x" if c.isalpha() else c
        if out[-2:] != [s, s]:
            out.append(s)
    return "".join(out)


def features(word: str) -> tuple[str, ...]:
    """Of a run of characters without white space."""
    core = word.strip("'\"()[]{}<>,.;:!?|*#$%&=")
    head, _, value = core.partition("=")
    cue = CUE.get((head if value else core).lower(), "")
    body = (value or core).strip("'\"")
    letters, digits = any(map(str.isalpha, body)), sum(map(str.isdigit, body))
    kind = f"mixed{min(digits // 4, 2)}" if letters and digits else f"digits{min(digits, 10)}" if digits else "letters" if letters else "marks"
    if value:
        return (f"given={cue}", f"given={cue}/{kind}")
    found = [f"cue={cue}"] if cue else []
    found += [f"shape={shape(core)}", f"kind={kind}"]
    if kind.startswith("mixed"):
        found.append(f"long={len(core) >= 8}")
    if word[-1:] in ".,;:!?|=":
        found.append(f"end={word[-1]}")
    if len(word) > len(core) and word[:1] in "\"'<([":
        found.append("quoted")
    return tuple(found)


# ---------------------------------------------------------------- training table

#: Fixed values of the templates' slots.
GIVEN = ("Anna", "John", "Maria", "Peter", "Laura", "Hugo", "Clara", "Thomas", "Élodie", "Jürgen")
FAMILY = ("Smith", "Garcia", "Müller", "Dupont", "Jones", "Keller", "Moreau", "Lopez", "Brown", "Weber")
PLAIN = (
    "the meeting was moved to another day", "We saw 12 of them in 1998 and 2004 again",
    "Results are listed in table 3, see page 14", "this is a plain sentence. Another one follows it",
    "the key question is open", "the name of the river is old", "He asked for a token of thanks",
    "Social security is a wide field", "Order 20418 was sent on 12.05.2019", "a4 paper and mp3 files",
    "version 2.4.1 is out | stable", "the secret is out. The pin is lost", "Total: 1,200.50 in 3 parts",
    "This is Monday. It is Friday", "das ist Wasser und Brot", "size=20 and width=3", "the password is lost",
    "call 555-3296 or 4524132264652876", "see 42.144.35.254 or tf.42@mail8.example.com there", "a=b",
)
MADE = (
    ("My name is {person} and I live here", "person"), ("Mr {person} was there", "person"),
    ("signed by Dr. {person}, on behalf", "person"), ("Name: {person}", "person"),
    ("Frau {person} kam", "person"), ("then Mrs. {person} left. It rained", "person"),
    ("SSN {identity} was given", "identity"), ("social security number {identity}.", "identity"),
    ("identity number: {identity} for the file", "identity"), ("passport {identity} expired", "identity"),
    ("password={secret} then", "secret"), ('token = "{secret}" in the file', "secret"),
    ("api_key: {secret}", "secret"), ("the password is {secret}", "secret"), ("secret={secret}", "secret"),
    ("Password: {secret} and more", "secret"),
)


def labelled_lines(seed: int = 7, each: int = 6, plain: int = 140) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Lines with their spans: templates with drawn fillers, fixed plain lines, and lines of made-up words."""
    draw = np.random.default_rng(seed)

    def pick(values) -> str:
        return values[int(draw.integers(len(values)))]

    def text_of(alphabet: str, size: int) -> str:
        return "".join(alphabet[i] for i in draw.integers(len(alphabet), size=size))

    def filler(kind: str) -> str:
        if kind == "person":
            return f"{pick(GIVEN)} {pick(FAMILY)}" if draw.random() < 0.8 else pick(FAMILY)
        if kind == "identity":
            return f"{draw.integers(100, 999)}-{draw.integers(10, 99)}-{draw.integers(1000, 9999)}"
        if draw.random() < 0.6:
            return "0123456789"[int(draw.integers(10))] + text_of("0123456789abcdef", int(draw.integers(8, 40)))
        return "7" + text_of("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789", int(draw.integers(8, 24)))

    def made_up() -> str:
        """Sentences, capitals, tables and decorated words, as prose and junk have them."""
        style, words = int(draw.integers(5)), []
        for k in range(int(draw.integers(4, 14))):
            word = text_of("aeioustrnmlé", int(draw.integers(1, 10)))
            if style == 1:
                word = word.upper() + "!!"
            elif style == 2:
                word += pick(("###", "$$$", "%%%", "***", "&&&", ".###", ",%%%"))
            elif k == 0 or words[-1].endswith(".") or style == 4 and draw.random() < 0.4:
                word = word.capitalize()
            if style in (0, 4) and draw.random() < 0.25:
                word += pick((".", ",", ".", ",", ":"))
            words += [word, "|"] if style == 3 else [word]
        return " ".join(words)

    lines = []
    for template, kind in MADE:
        for k in range(each):
            value, head = filler(kind), f"{made_up() if k % 3 else pick(PLAIN)} " if k % 2 else ""
            before, after = template.split("{" + kind + "}")
            start = len(head + before)
            lines.append((head + before + value + after, [(start, start + len(value), kind)]))
    lines += [(line, []) for line in PLAIN for _ in range(2)]
    return lines + [(made_up(), []) for _ in range(plain)]


# ---------------------------------------------------------------- the field

STATES = ("O", *(f"{p}-{kind}" for kind in ADDED for p in "BI"))
#: Scores that no path may take.
FORBIDDEN = -1e4


def allowed() -> np.ndarray:
    """Transitions: an inner state follows its own kind only."""
    ok = np.ones((len(STATES), len(STATES)), dtype=bool)
    for j, to in enumerate(STATES):
        if to[0] == "I":
            ok[:, j] = [frm[2:] == to[2:] and frm != "O" for frm in STATES]
    return ok


class Field:
    """Weights of the features by state, transitions, first states; words' rows are remembered."""

    REMEMBERED = 200_000

    def __init__(self, names: dict[str, int], weights: np.ndarray, moves: np.ndarray, first: np.ndarray):
        self.names, self.weights, self.moves, self.first = names, weights, moves, first
        self.forget()

    def forget(self) -> None:
        #: Words by what they add: scores at their own place, to the next two and to the one before.
        self.place: dict[str, int] = {}
        self.sets: dict[tuple[str, ...], int] = {}
        self.row_of = np.zeros(0, np.int32)
        self.rows = np.zeros((0, len(SIDES), len(STATES)), np.float32)

    def __getstate__(self):
        return (self.names, self.weights, self.moves, self.first)

    def __setstate__(self, state):
        self.__init__(*state)

    def _row(self, own: tuple[str, ...]) -> np.ndarray:
        row = np.zeros((len(SIDES), len(STATES)), dtype=np.float32)
        for feature in own:
            for side, name in enumerate(SIDES):
                if (i := self.names.get(f"{name}:{feature}")) is not None:
                    row[side] += self.weights[i]
        return row

    def lookup(self, lines: list[list[str]], count: int) -> np.ndarray:
        """The row number of each word, in order."""
        if len(self.place) > self.REMEMBERED:
            self.forget()
        new = list(set().union(*lines).difference(self.place))
        rows, at = [], []
        for own in map(features, new):
            if own not in self.sets:
                self.sets[own] = len(self.sets)
                rows.append(self._row(own))
            at.append(self.sets[own])
        self.place.update(zip(new, range(len(self.row_of), len(self.row_of) + len(new)), strict=True))
        self.row_of = np.concatenate([self.row_of, np.array(at, dtype=np.int32)])
        if rows:
            self.rows = np.concatenate([self.rows, np.stack(rows)])
        return self.row_of[np.fromiter(map(self.place.__getitem__, chain.from_iterable(lines)), np.int64, count)]

    def may_hold(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of each line, whether a path through a span may be worth as much as the path outside all.

        A span begins at a word, and gains there no more than its kind's first state does with the
        best transition into it; after that, no more than all later words gain that gain anything
        inside, and at its end the best transition out.  Where that is a loss from every word on,
        leaving any span out makes a path better.
        """
        begin, inside = np.arange(1, len(STATES), 2), np.arange(2, len(STATES), 2)
        stay = self.moves[0, 0]
        into = self.moves[:, begin].max(axis=0) - stay
        on = np.maximum(self.moves[begin, inside], self.moves[inside, inside]) - stay
        out = max(self.moves[1:, 0].max() - stay, 0)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        first = (scores[:, begin] - scores[:, :1] + into).max(axis=1)
        at_start = scores[starts][:, begin] - scores[starts][:, :1] + self.first[begin] - self.first[0]
        first[starts] = np.maximum(first[starts], at_start.max(axis=1))
        later = np.maximum(scores[:, inside] - scores[:, :1] + on, 0).max(axis=1)
        sums = np.concatenate([[0], np.cumsum(later, dtype=np.float64)])
        rest = sums[np.repeat(ends, lengths)] - sums[1:]
        return np.maximum.reduceat(first + rest + out, starts) > -ROUNDING

    def emissions(self, at: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Scores by word and state; ``at`` are the row numbers of sequences one after another."""
        out = self.rows[at, 0]
        place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        left = np.repeat(lengths, lengths) - place
        for side, (name, shift) in enumerate(SIDES.items()):
            if name != "self":
                ok = np.flatnonzero(place >= -shift if shift < 0 else left > shift)
                out[ok] += self.rows[at[ok + shift], side]
        return out


def padded(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sequences as a matrix sequence x place x state, padded with zeros."""
    at = np.arange(int(lengths.max()))
    index = np.minimum(starts[:, None] + at, len(flat) - 1)
    return np.where((at < lengths[:, None])[..., None], flat[index], 0)


def viterbi(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best states of each padded sequence; one sequence a column, so that steps run over whole rows."""
    scores = np.ascontiguousarray(scores.transpose(1, 2, 0))
    width, n, rows = scores.shape
    back = np.zeros((width, n, rows), dtype=np.int8)
    best = scores[0] + first[:, None]
    for t in range(1, width):
        step, frm = best[0] + moves[0][:, None], np.zeros((n, rows), dtype=np.int8)
        for i in range(1, n):
            through = best[i] + moves[i][:, None]
            better = through > step
            np.maximum(step, through, out=step)
            frm[better] = i
        live = t < lengths
        back[t] = np.where(live, frm, np.arange(n, dtype=np.int8)[:, None])
        best = np.where(live, step + scores[t], best)
    states = np.zeros((width, rows), dtype=np.int8)
    each = np.arange(rows)
    states[-1] = best.argmax(axis=0)
    for t in range(width - 1, 0, -1):
        states[t - 1] = back[t, states[t], each]
    return states.T


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


RUN = re.compile(r"\S+")


@cache
def trained(rounds: int = 110, penalty: float = 1e-3, seed: int = 7) -> Field:
    """Weights that maximise the penalised likelihood of the labelled lines (Adam on exact gradients)."""
    lines, names = labelled_lines(seed), {}
    places, golds = [], []
    for line, spans in lines:
        words, states, sets = list(RUN.finditer(line)), [], []
        for m in words:
            own = next((s for s in spans if s[0] < m.end() and m.start() < s[1]), None)
            states.append(0 if own is None else STATES.index(("B-" if m.start() <= own[0] else "I-") + own[2]))
        own_features = [features(m.group()) for m in words]
        for i in range(len(words)):
            near = [(side, i + shift) for side, shift in SIDES.items() if 0 <= i + shift < len(words)]
            sets.append([names.setdefault(f"{side}:{f}", len(names)) for side, j in near for f in own_features[j]])
        places.append(sets)
        golds.append(states)
    rows, width, n = len(lines), max(map(len, golds)), len(STATES)
    lengths = np.array(list(map(len, golds)))
    gold = np.zeros((rows, width), dtype=np.int64)
    r, t, f = [], [], []
    for i, (sets, states) in enumerate(zip(places, golds, strict=True)):
        gold[i, : len(states)] = states
        for j, ids in enumerate(sets):
            r += [i] * len(ids)
            t += [j] * len(ids)
            f += ids
    r, t, f = np.array(r), np.array(t), np.array(f)
    ok = allowed()
    start_ok = np.array([s[0] != "I" for s in STATES])
    weights, moves, first = np.zeros((len(names), n)), np.zeros((n, n)), np.zeros(n)
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, moves, first)]
    live = np.arange(width) < lengths[:, None]
    each = np.arange(rows)
    for k in range(1, rounds + 1):
        scores = np.zeros((rows, width, n))
        np.add.at(scores, (r, t), weights[f])
        m, s = np.where(ok, moves, FORBIDDEN), np.where(start_ok, first, FORBIDDEN)
        forward = np.zeros((rows, width, n))
        forward[:, 0] = scores[:, 0] + s
        for j in range(1, width):
            step = _logsumexp(forward[:, j - 1, :, None] + m, 1) + scores[:, j]
            forward[:, j] = np.where(live[:, j, None], step, forward[:, j - 1])
        backward = np.zeros((rows, width, n))
        for j in range(width - 2, -1, -1):
            step = _logsumexp(m + (scores[:, j + 1] + backward[:, j + 1])[:, None, :], 2)
            backward[:, j] = np.where(live[:, j + 1, None], step, 0)
        total = _logsumexp(forward[:, -1], 1)
        state = np.exp(forward + backward - total[:, None, None]) * live[..., None]
        d_moves, d_first = np.zeros((n, n)), -state[:, 0].sum(axis=0)
        for j in range(1, width):
            pair = np.exp(forward[:, j - 1, :, None] + m + (scores[:, j] + backward[:, j])[:, None, :] - total[:, None, None])
            d_moves -= (pair * live[:, j, None, None]).sum(axis=0)
            np.add.at(d_moves, (gold[:, j - 1][live[:, j]], gold[:, j][live[:, j]]), 1)
        np.add.at(d_first, gold[:, 0], 1)
        error = -state
        for j in range(width):
            error[each[live[:, j]], j, gold[:, j][live[:, j]]] += 1
        d_weights = np.zeros_like(weights)
        np.add.at(d_weights, f, error[r, t])
        for p, d, mv in zip((weights, moves, first), (d_weights, d_moves, d_first), moments, strict=True):
            g = d / rows - penalty * p
            mv[0] = 0.9 * mv[0] + 0.1 * g
            mv[1] = 0.99 * mv[1] + 0.01 * g * g
            p += 0.15 * (mv[0] / (1 - 0.9**k)) / (np.sqrt(mv[1] / (1 - 0.99**k)) + 1e-8)
    return Field(
        names, weights.astype(np.float32),
        np.where(ok, moves, FORBIDDEN).astype(np.float32), np.where(start_ok, first, FORBIDDEN).astype(np.float32),
    )


#: Scores of one padded batch of lines.
CELLS = 1 << 20
#: What rounding may cost a path, and more.
ROUNDING = 1e-2


def field_spans(field: Field, docs: list[str]) -> list[list[tuple[int, int, str]]]:
    """Spans of the added kinds in each text."""
    split = [text.split("\n") for text in docs]
    found = line_spans(field, list(dict.fromkeys(chain.from_iterable(split))))
    out: list[list[tuple[int, int, str]]] = [[] for _ in docs]
    if found:
        for own, lines in zip(out, split, strict=True):
            start = 0
            for line in lines:
                own += [(start + a, start + b, kind) for a, b, kind in found.get(line, ())]
                start += len(line) + 1
    return out


def line_spans(field: Field, texts_: list[str]) -> dict[str, list[tuple[int, int, str]]]:
    """The spans of the lines that have any."""
    lines = [x.split() for x in texts_]
    filled = [k for k, words in enumerate(lines) if words]
    if not filled:
        return {}
    lines = [lines[k] for k in filled]
    sizes = np.array(list(map(len, lines)))
    scores = field.emissions(field.lookup(lines, int(sizes.sum())), sizes)
    held = field.may_hold(scores, sizes)
    if not held.any():
        return {}
    open_, scores, sizes = np.flatnonzero(held), scores[np.repeat(held, sizes)], sizes[held]
    states = labelled(field, scores, sizes)
    ends = np.cumsum(sizes)
    hits = np.flatnonzero(states)
    found: dict[str, list[tuple[int, int, str]]] = {}
    for d in np.unique(np.searchsorted(ends, hits, side="right")).tolist():
        base, text = int(ends[d] - sizes[d]), texts_[filled[open_[d]]]
        own: list[tuple[int, int, str]] = []
        runs_ = list(RUN.finditer(text))
        for i in hits[(hits >= base) & (hits < ends[d])].tolist():
            kind, m = STATES[states[i]][2:], runs_[i - base]
            a, b = CORE.match(m.group()).span(1)
            if a == b:
                continue
            if STATES[states[i]][0] == "I" and own and own[-1][2] == kind and i > base and states[i - 1]:
                own[-1] = (own[-1][0], m.start() + b, kind)
            else:
                own.append((m.start() + a, m.start() + b, kind))
        if own:
            found[text] = own
    return found


def labelled(field: Field, flat: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The best state of each word of the lines, whose scores stand one after another."""
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(sizes, kind="stable")
    states = np.zeros(len(flat), dtype=np.int8)
    at = 0
    while at < len(order):
        least = int(sizes[order[at]])
        most = int(1.25 * least) + 3  # lines of like length, whose padded scores stay within the bound
        to = min(int(np.searchsorted(sizes[order], most, side="right")), at + max(1, CELLS // (most * len(STATES))))
        part = order[at:to]
        found = viterbi(padded(flat, starts[part], sizes[part]), sizes[part], field.moves, field.first)
        places = np.arange(found.shape[1])
        live = places < sizes[part][:, None]
        states[(starts[part][:, None] + places)[live]] = found[live]
        at = to
    return states


def all_spans(base: list[tuple[int, int, str]], added: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    free = [s for s in added if not any(s[0] < b and a < s[1] for a, b, _ in base)]
    return sorted([*base, *free], key=lambda s: (s[0], ORDER[s[2]]))


def listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each stretch of spans replaced by the kind of its first."""
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def find(df: DataFrame, text: str = "text", redact: str | None = None) -> DataFrame:
    """``df`` with ``base`` and ``spans`` (kind:start:end, code points, end exclusive, joined by commas).

    ``redact`` names a column for the text with its spans replaced; it may be ``text``
    itself.  A null text stays null there.
    """
    new = ["base", "spans"] + ([redact] if redact else [])
    kept = [f for f in df.schema.fields if f.name not in new or f.name == redact]
    schema = T.StructType([
        *(f for f in kept if f.name != redact), *(T.StructField(c, T.StringType()) for c in new)
    ])

    field = trained()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                docs = texts(part, text)
                base = [base_spans(x) for x in docs]
                spans = [all_spans(b, a) for b, a in zip(base, field_spans(field, docs), strict=True)]
                columns = {f.name: part.column(f.name) for f in schema.fields if f.name not in new}
                columns["base"] = pa.array(map(listed, base), pa.string())
                columns["spans"] = pa.array(map(listed, spans), pa.string())
                if redact:
                    raw = part.column(text).to_pylist()
                    columns[redact] = pa.array([x if x is None else redacted(x, s) for x, s in zip(raw, spans, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
        field.forget()
        release()

    return df.mapInArrow(work, schema)
