"""Secret scan: fixed formats plus sliding-window entropy.

Base kinds (leftmost, non-overlapping by kind): assign (a named value), access
(an access key id) and hex (a long hexadecimal string). The method adds spans
of high entropy: in every candidate string (a maximal run of characters that
keys are made of) a window of ``WINDOW`` characters slides along while the
counts of its characters, and from them its Shannon entropy, are kept up to
date by one step in and one step out, as are the counts of its classes. A
window whose entropy reaches the bound of its own class (digits, hexadecimal
digits of one case, letters of one case, mixed letters, letters of one case
with digits as in base32, and all of them as in base64) marks its characters.

Windows stay inside the parts between / = _ - of a candidate; parts that mix
cases as keys do and words don't are one part with such neighbours, since
base64 uses some of these marks itself. Windows that read like words (letter
pairs that are common in European languages make up ``WORDY`` of all) mark
nothing. What is on the allow-list, such as identifiers in UUID form and
placeholder words, adds nothing: the part that holds it is left out, its
neighbours are scanned.

One pass over the texts, no shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strainmeter.llm import textvec as tv
from strainmeter.llm.tables import fresh, ship

WINDOW = 20
#: Bits a window has at least, by character class: 98 to 99 of 100 windows of random
#: characters of the class have as many.
BOUNDS = {"digits": 2.57, "hex": 2.88, "letters": 3.28, "mixed": 3.61, "base32": 3.40, "base64": 3.67}
#: Share of common pairs among a window's letter pairs that makes it wordy.
WORDY = 0.4
#: Common letter pairs of English, French, German and Spanish.
COMMON = frozenset(
    "th he in er an re nd on en at ou ed ha to or it is hi es ng st ar te se ti al le ri ro ra ve co me de ea li ne ma ic io "
    "ll ch el us la om ur no ta ce ca si di lo ec po pr pe ho et il ac tr un ei ie ge be ai eu qu ue os ad as sc da ut id ot na au am rt ts".split()
)
ALLOWED = (
    r"(?<![0-9a-zA-Z])[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}(?![0-9a-zA-Z])",
    r"(?i)example|sample|placeholder|changeme|dummy|redacted|lorem",
    r"^sha(1|256|384|512)[-=]",
    r"(?i)abcdefghij|0123456789",
)
REPLACEMENT = "[SECRET]"

#: The base patterns and the order of kinds.
KINDS = ("assign", "access", "hex", *(f"entropy_{c}" for c in BOUNDS))
_ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
_CAPITALISED = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_KEY = np.zeros(256, bool)
_KEY[[*range(48, 58), *range(65, 91), *range(97, 123), *b"+/_=-"]] = True
_MARK = np.zeros(256, bool)
_MARK[[*b":="]] = True

#: c log2 c for the counts of a window
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]


_LOWER, _UPPER = frozenset("0123456789abcdef"), frozenset("0123456789ABCDEF")


def char_class(text: str) -> str:
    """Class of a string of key characters."""
    upper, lower, digit = (any(f(c) for c in text) for f in (lambda c: "A" <= c <= "Z", lambda c: "a" <= c <= "z", lambda c: "0" <= c <= "9"))
    return _class(upper, lower, digit, any(not c.isalnum() for c in text), set(text) <= _LOWER or set(text) <= _UPPER)


def _class(upper: bool, lower: bool, digit: bool, mark: bool, hexadecimal: bool) -> str:
    if mark or (upper and lower and digit):
        return "base64"
    if digit:
        return "hex" if hexadecimal and (upper or lower) else "base32" if upper or lower else "digits"
    return "mixed" if upper and lower else "letters"


def dense(text: str, bounds: dict[str, float] | float = BOUNDS, wordy: float = WORDY) -> list[tuple[int, int]]:
    """Spans of ``text`` covered by windows with as much entropy as the bound
    of their class that don't read like words."""
    if isinstance(bounds, float):
        bounds = dict.fromkeys(BOUNDS, bounds)
    counts: dict[str, int] = {}
    low = upper_hex = 0  # length of the run of hexadecimal digits of either case that ends here
    kinds = {"u": 0, "l": 0, "d": 0, "m": 0}
    sort = ["u" if "A" <= c <= "Z" else "l" if "a" <= c <= "z" else "d" if "0" <= c <= "9" else "m" for c in text]
    small = text.lower()
    pair = [0] + [(sort[i] in "ul" and sort[i - 1] in "ul") + (small[i - 1 : i + 1] in COMMON) for i in range(1, len(text))]  # 0 none, 1 letters, 2 common
    letters = common = 0
    total = 0.0
    out: list[tuple[int, int]] = []
    top = math.log2(WINDOW)
    for i, c in enumerate(text):
        if i >= WINDOW:
            old = text[i - WINDOW]
            n = counts[old]
            counts[old] = n - 1
            total += _TERM[n - 1] - _TERM[n]
            kinds[sort[i - WINDOW]] -= 1
            gone = pair[i - WINDOW + 1]
            letters -= gone > 0
            common -= gone > 1
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += _TERM[n + 1] - _TERM[n]
        kinds[sort[i]] += 1
        letters += pair[i] > 0
        common += pair[i] > 1
        low = low + 1 if c in _LOWER else 0
        upper_hex = upper_hex + 1 if c in _UPPER else 0
        if i < WINDOW - 1:
            continue
        a = i - WINDOW + 1
        least = bounds[_class(kinds["u"] > 0, kinds["l"] > 0, kinds["d"] > 0, kinds["m"] > 0, low >= WINDOW or upper_hex >= WINDOW)]
        if top - total / WINDOW >= least - 1e-9 and not (letters >= 6 and common >= wordy * letters):
            if out and out[-1][1] >= a:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((a, i + 1))
    return out


def _parts(run: str, first: int, last: int) -> list[tuple[int, int]]:
    """Stretches of at least a window between the marks / = _ -; parts that
    mix cases within (or have up to three characters) are joined over one
    mark, if one of them mixes."""
    cut = [m.span() for m in re.finditer(r"[^/=_-]+", run[first:last])]
    out: list[list] = []
    for a, b in cut:
        part = run[first + a : first + b]
        mixes = any(c.islower() for c in part) and any(c.isupper() for c in part) and not _CAPITALISED.fullmatch(part)
        joins = mixes or b - a <= 3
        if out and joins and out[-1][2] and a == out[-1][1] + 1 and run[first + a - 1] != "=":
            out[-1] = [out[-1][0], b, True, out[-1][3] or mixes]
        else:
            out.append([a, b, joins, mixes])
    return [(first + a, first + b) for a, b, _, mixes in out if b - a >= WINDOW]


def _open(run: str, allowed: tuple[str, ...]) -> list[tuple[int, int]]:
    """Stretches of ``run`` that the allow-list leaves: without each part
    between / = _ - that a match reaches into. A match that ends in a mark
    (sha256-) names the value behind it, up to the next = _ -."""
    shut = []
    for p in allowed:
        for m in re.finditer(p, run):
            a, b = m.span()
            if a == b:
                continue
            while a and run[a - 1] not in "/=_-":
                a -= 1
            marks = "=_-" if run[b - 1] in "/=_-" else "/=_-"
            while b < len(run) and run[b] not in marks:
                b += 1
            shut.append((a, b))
    out, at = [], 0
    for a, b in sorted(shut):
        out.append((at, a))
        at = max(at, b)
    return [(a, b) for a, b in [*out, (at, len(run))] if b - a >= WINDOW]


def spans(text: str, allowed: tuple[str, ...] = ALLOWED) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all secrets by start, then kind."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8] if "=" in text or ":" in text else []
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    base = list(out)
    for m in _CANDIDATE.finditer(text):
        run = m.group()
        for opened in _open(run, allowed):
            for first, last in _parts(run, *opened):
                for a, b in dense(run[first:last]):
                    a, b = a + first + m.start(), b + first + m.start()
                    if not any(x <= a and b <= y for _, x, y in base):
                        out.append((f"entropy_{char_class(text[a:b])}", a, b))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def masked(text: str, found: list[tuple[str, int, int]], replacement: str = REPLACEMENT) -> str:
    """``text`` with the union of the spans replaced."""
    out, last = [], 0
    merged: list[list[int]] = []
    for _, a, b in sorted(found, key=lambda s: s[1]):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[last:a], replacement]
        last = b
    return "".join(out) + text[last:]


def suspects(texts: pa.Array) -> np.ndarray:
    """Rows that can hold a secret: a run of 16 key characters or a mark of
    assignment. All kinds need one of the two."""
    raw, offsets = tv.view(texts)
    start, end = tv.runs(_KEY[raw])
    at = np.concatenate([start[end - start >= 16], np.flatnonzero(_MARK[raw])])
    return np.unique(np.searchsorted(offsets, at, "right") - 1)


_FOUND = "n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string, masked string"
_EMPTY = hashlib.sha256(b"").hexdigest()


def _scanner(allowed: tuple[str, ...], mask: bool):
    kind = pa.struct([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_entropy", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("masked", pa.string())])

    def scan(column: pa.Array) -> pa.Array:
        nothing = {"n_assign": 0, "n_access": 0, "n_hex": 0, "n_entropy": 0, "base_sha256": _EMPTY, "spans": "", "masked": None}
        out = [nothing] * len(column)
        for row, piece in tv.slices(column):
            for i in suspects(piece).tolist():
                text = piece[i].as_py()
                found = spans(text, allowed)
                if found:
                    n = {k: sum(f[0] == k for f in found) for k in KINDS}
                    base = joined([f for f in found if f[0] in KINDS[:3]])
                    out[row + i] = {"n_assign": n["assign"], "n_access": n["access"], "n_hex": n["hex"], "n_entropy": sum(n[k] for k in KINDS[3:]), "base_sha256": hashlib.sha256(base.encode()).hexdigest(), "spans": joined(found), "masked": masked(text, found) if mask else None}
        return pa.array(out, kind)

    return F.arrow_udf(scan, _FOUND)


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, n_entropy,
    base_sha256 (of the base spans) and spans (all; kind:start:end by start,
    then kind; code points, end exclusive).

    A null text is empty and has no span. Null ids, repeated rows and other
    columns change nothing; other columns aren't read."""
    ship(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("_id"), _scanner(allowed, False)(F.col(text_col)).alias("_s"))
    return out.select(F.col("_id").alias(id_col), "_s.*").drop("masked")


def redacted(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with every secret in the text replaced, and ``size_col``, where
    there is such a column, set anew for changed texts. No row goes."""
    ship(docs.sparkSession)
    new = fresh(docs, "_secrets")
    changed = F.col(new)["masked"]
    out = docs.withColumn(new, _scanner(allowed, True)(F.col(text_col)))
    cols = []
    for c, kind in docs.dtypes:
        if c == text_col:
            cols.append(F.coalesce(changed, F.col(c)).alias(c))
        elif c == size_col:
            cols.append(F.when(changed.isNotNull(), F.length(changed).cast(kind)).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)
