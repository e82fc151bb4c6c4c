"""Personal data by rules and a semi-Markov conditional random field.

Rules find spans of four kinds; each kind is matched from left to right
without overlap, and matches that fail their check are dropped.  The field
then looks at the places between: white-space tokens that hold a digit, an at
sign or a bracketed "at" or "dot" make islands, and every run of up to
MAX_TOKENS tokens of an island is a candidate for every kind.  A candidate is
scored as a whole (its digits, groups, separators, checks and the word before
it), and a dynamic programme over the island chooses the boundaries and kinds
that are best together.  Outside islands no candidate exists, so the best
labelling of a text is made of the best labellings of its islands.

The weights maximise the conditional likelihood of labelled islands: islands
of the corpus, labelled by the rules' spans, and from each of them disguised
forms that the rules miss (other separators, spelled out signs) and look-alikes
that are no personal data.  At most MAX_TRAIN_ISLANDS islands, chosen by hash,
reach the driver.  Spans of the field that overlap no span of the rules are
added to them.

Offsets are code points, ends exclusive.  Null texts count as empty; an
empty text has no spans; repeated rows get equal spans; an empty table gives no
rows; all work is linear in the length of a text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 7
MAX_TRAIN_ISLANDS = 1200
#: Islands with more tokens teach nothing that shorter ones don't.
MAX_TRAIN_TOKENS = 24

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGN = re.compile(r"[0-9@]|[(\[{](?:at|dot)[)\]}]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number fits."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def rule_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the rules, by kind and start."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        # the local part ends at the sign and holds none, so it lies after the last one
        local = text[done:at]
        start = done + len(local.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        groups, pos, k = m.group().split("."), m.start(), 0
        begin = []
        for g in groups:
            begin.append(pos)
            pos += len(g) + 1
        while k + 3 < len(groups):
            four = groups[k : k + 4]
            if all(four):
                if all(len(g.lstrip("0")) <= 3 and int(g.lstrip("0") or 0) <= 255 for g in four):
                    out.append(("ip", begin[k], begin[k + 3] + len(four[3])))
                k += 4
            else:
                k += 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_only_digits(m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def islands(text: str):
    """Lists of (start, end) of consecutive tokens around signs."""
    tokens = [m.span() for m in _WORD.finditer(text)]
    marked = [k for k, (a, b) in enumerate(tokens) if _SIGN.search(text, a, b)]
    lo = hi = None
    for k in marked:
        if lo is not None and k - 1 <= hi:
            hi = k + 1
            continue
        if lo is not None:
            yield tokens[max(lo, 0) : hi + 1]
        lo, hi = k - 1, k + 1
    if lo is not None:
        yield tokens[max(lo, 0) : hi + 1]


_OPEN, _CLOSE = "\"'<[{,;:*&%#$|=", ".,;:!?\"'>]}*&%#$|="
_GROUPS = re.compile(r"[0-9]+")
_AT = re.compile(r"[(\[{]at[)\]}]")
_DOT = re.compile(r"[(\[{]dot[)\]}]")
_BLANK = re.compile(r"\s")
_JOINED_DOT = re.compile(r"\s*[(\[{]dot[)\]}]\s*")
_TAIL = re.compile(r"(?:\.|[(\[{]dot[)\]}])\s?[A-Za-z]{2,}$")
_CUES = {
    "email": {"mail", "email", "e-mail", "contact", "write"}, "ip": {"ip", "host", "server", "address", "addr"},
    "card": {"card", "visa", "credit", "pan", "cc"}, "phone": {"tel", "phone", "call", "fax", "mobile", "dial"}}
_FEATURES: list[str] = [
    "bias", "at", "two at", "spelled at", "name tail", "spelled dot", "letters", "letters without at", "all hex",
    "digits 0", "digits 1-3", "digits 4-7", "digits 8-9", "digits 10", "digits 11-13", "digits 14-15", "digits 16",
    "digits 17-19", "digits 20+", "luhn holds", "luhn fails", "four octets", "octets by dot", "plain digits",
    "plus", "parenthesis", "dashes", "slash", "colon", "comma", "dots", "blanks", "groups 3 3 4", "groups 1 3 3 4",
    "groups 4 4 4 4", "one name and host", "no one name and host", "two groups", "many groups", "tokens 1", "tokens 2", "tokens 3", "tokens 4+", "other signs",
    *(f"cue {k}" for k in KINDS)]
_AT_FEATURE = {f: i for i, f in enumerate(_FEATURES)}


def span_of(text: str, tokens, i: int, j: int) -> tuple[int, int]:
    """Characters of tokens i to j - 1 without wrapping signs; empty if nothing is left."""
    a, b = tokens[i][0], tokens[j - 1][1]
    while a < b and text[a] in _OPEN:
        a += 1
    while a < b and (text[b - 1] in _CLOSE or text[b - 1] == ")" and "(" not in text[a:b]):
        b -= 1
    if a < b and text[a] == "(" and ")" not in text[a:b]:
        a += 1
    return a, b


def span_features(s: str, n_tokens: int, before: str) -> list[int]:
    """Numbers of the features that hold for a whole candidate."""
    groups = _GROUPS.findall(s)
    digits = "".join(groups)
    n = len(digits)
    ats, spelled = s.count("@"), bool(_AT.search(s))
    plain = _DOT.sub("", _AT.sub("", s))
    letters = any(c.isalpha() for c in plain)
    f = ["bias"]
    f += ["at"] * (ats == 1) + ["two at"] * (ats > 1) + ["spelled at"] * spelled + ["name tail"] * bool(_TAIL.search(s))
    if spelled:
        cut = _AT.search(s)
        name, host = s[: cut.start()].strip(), _JOINED_DOT.sub(".", s[cut.end() :]).strip()
        one = bool(name) and "." in host and not _BLANK.search(name) and not _BLANK.search(host)
        f.append("one name and host" if one else "no one name and host")
    f += ["spelled dot"] * bool(_DOT.search(s)) + ["letters"] * letters + ["letters without at"] * (letters and not ats and not spelled)
    f += ["all hex"] * (letters and n > 0 and all(c in "0123456789abcdefABCDEF" for c in s))
    for name, lo, hi in (("0", 0, 0), ("1-3", 1, 3), ("4-7", 4, 7), ("8-9", 8, 9), ("10", 10, 10), ("11-13", 11, 13),
                         ("14-15", 14, 15), ("16", 16, 16), ("17-19", 17, 19), ("20+", 20, 1 << 60)):
        if lo <= n <= hi:
            f.append(f"digits {name}")
    if 16 <= n <= 19:
        f.append("luhn holds" if luhn(digits) else "luhn fails")
    if len(groups) == 4 and not letters and all(len(g) <= 3 and int(g) <= 255 for g in groups):
        f += ["four octets"] + ["octets by dot"] * (s.count(".") == 3)
    signs = set(s) - set("0123456789")
    f += ["plain digits"] * (not signs) + ["plus"] * s.startswith("+") + ["parenthesis"] * ("(" in signs and not spelled)
    f += ["dashes"] * ("-" in signs) + ["slash"] * ("/" in signs) + ["colon"] * (":" in signs) + ["comma"] * ("," in signs)
    f += ["dots"] * ("." in signs) + ["blanks"] * bool(signs & set(" \t\n"))
    sizes = tuple(map(len, groups))
    f += {(3, 3, 4): ["groups 3 3 4"], (1, 3, 3, 4): ["groups 1 3 3 4"], (4, 4, 4, 4): ["groups 4 4 4 4"]}.get(sizes, [])
    f += ["two groups"] * (len(sizes) == 2) + ["many groups"] * (len(sizes) > 4)
    f.append(f"tokens {n_tokens}" if n_tokens < 4 else "tokens 4+")
    f += ["other signs"] * bool(set(c for c in plain if not c.isalnum()) - set("@.-+() _/:,%\t\n[]"))
    word = before.strip(_OPEN + _CLOSE).lower()
    f += [f"cue {k}" for k in KINDS if word in _CUES[k]]
    return [_AT_FEATURE[x] for x in f]


@dataclass
class Lattice:
    """The candidates of an island: token bounds, characters, and features."""

    n: int
    bounds: list[tuple[int, int]]
    spans: list[tuple[int, int]]
    active: list[list[int]]


def lattice(text: str, tokens) -> Lattice:
    bounds, spans, active = [], [], []
    for i in range(len(tokens)):
        for j in range(i + 1, min(len(tokens), i + MAX_TOKENS) + 1):
            if tokens[j - 1][1] - tokens[j - 1][0] > 80 or tokens[j - 1][1] - tokens[i][0] > 160:
                break  # no entity is that long
            a, b = span_of(text, tokens, i, j)
            # wrapping signs may not hide a whole token, and a candidate holds a sign
            if a >= b or a >= tokens[i][1] or b <= tokens[j - 1][0] or not _SIGN.search(text, a, b):
                continue
            before = text[tokens[i - 1][0] : tokens[i - 1][1]][-40:] if i else ""
            bounds.append((i, j))
            spans.append((a, b))
            active.append(span_features(text[a:b], j - i, before))
    return Lattice(len(tokens), bounds, spans, active)


def _scores(lat: Lattice, weights: np.ndarray) -> np.ndarray:
    """Score of every candidate for every kind."""
    if not lat.active:
        return np.zeros((0, len(KINDS)))
    flat = np.concatenate([np.asarray(a) for a in lat.active])
    cuts = np.cumsum([0, *(len(a) for a in lat.active[:-1])])
    return np.add.reduceat(weights[:, flat], cuts, axis=1).T


def best_spans(lat: Lattice, weights: np.ndarray) -> list[tuple[str, int, int]]:
    """The best joint choice of boundaries and kinds; other tokens score zero."""
    s = _scores(lat, weights)
    by_end: dict[int, list[int]] = {}
    for k, (_, j) in enumerate(lat.bounds):
        by_end.setdefault(j, []).append(k)
    best, back = [0.0] * (lat.n + 1), [None] * (lat.n + 1)
    top = s.argmax(axis=1) if len(s) else []
    for j in range(1, lat.n + 1):
        best[j] = best[j - 1]
        for k in by_end.get(j, ()):
            v = best[lat.bounds[k][0]] + float(s[k, top[k]])
            if v > best[j]:
                best[j], back[j] = v, k
    out, j = [], lat.n
    while j > 0:
        k = back[j]
        if k is None:
            j -= 1
        else:
            out.append((KINDS[top[k]], *lat.spans[k]))
            j = lat.bounds[k][0]
    return out[::-1]


def _gradient(lat: Lattice, gold: list[tuple[int, int]], weights: np.ndarray) -> np.ndarray:
    """Expected minus observed features: the gradient of minus the log-likelihood.

    gold: (candidate, kind) of the labelled spans."""
    s = _scores(lat, weights)
    n, bounds = lat.n, lat.bounds
    mass = np.logaddexp.reduce(s, axis=1) if len(s) else np.zeros(0)
    ahead, behind = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    ahead[0] = behind[n] = 0.0
    ends: dict[int, list[int]] = {}
    begins: dict[int, list[int]] = {}
    for k, (i, j) in enumerate(bounds):
        ends.setdefault(j, []).append(k)
        begins.setdefault(i, []).append(k)
    for j in range(1, n + 1):
        ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[bounds[k][0]] + mass[k] for k in ends.get(j, ()))])
    for i in range(n - 1, -1, -1):
        behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[bounds[k][1]] + mass[k] for k in begins.get(i, ()))])
    g = np.zeros_like(weights)
    if len(s):
        where = np.array([ahead[i] + behind[j] for i, j in bounds]) - ahead[n]
        p = np.exp(s + where[:, None])
        for kind, k in gold:
            p[k, kind] -= 1.0
        for k, a in enumerate(lat.active):
            g[:, a] += p[k][:, None]
    return g


def _hash(*parts) -> int:
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:12], 16)


def disguised(kind: str, s: str, seed: int) -> str:
    """Another way to write a found span, or "" if there is none."""
    d = _only_digits(s)
    if kind == "email":
        name, _, host = s.partition("@")
        return (f"{name} (at) {host}", f"{name}[at]{host}", f"{name} [at] {host.replace('.', ' [dot] ')}",
                f"{name}(at){host.replace('.', '(dot)')}")[seed % 4]
    if kind == "ip":
        return s.replace(".", ("[.]", "(.)")[seed % 2])
    if kind == "card" and len(d) == 16:
        parts = [d[k : k + 4] for k in range(0, 16, 4)]
        return ("/".join(parts), ".".join(parts), "_".join(parts))[seed % 3]
    if kind == "phone" and len(d) >= 10:
        a, b, c = d[-10:-7], d[-7:-4], d[-4:]
        return (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"({a}){b}-{c}")[seed % 3]
    return ""


def look_alike(seed: int) -> str:
    """Something with digits or signs that is no personal data."""
    r = lambda k, n: _hash(seed, k) % n
    sixteen = "".join(str(r(k, 10)) for k in range(16))
    if luhn(sixteen):
        sixteen = sixteen[:-1] + str((int(sixteen[-1]) + 1) % 10)
    return (f"{1900 + r(1, 200)}-{1 + r(2, 12):02d}-{1 + r(3, 28):02d}", f"{r(1, 24)}:{r(2, 60):02d}:{r(3, 60):02d}",
            f"{r(1, 20)}.{r(2, 20)}.{r(3, 20)}", f"{r(1, 900) + 100},{r(2, 900) + 100}.{r(3, 90) + 10}", sixteen,
            hashlib.md5(str(seed).encode()).hexdigest(), f"{300 + r(1, 600)}.{r(2, 999)}.{r(3, 999)}.{r(4, 999)}",
            f"{r(1, 10 ** 9)}", f"@name{r(1, 99)}", f"{1 + r(1, 12)}/{1 + r(2, 28)}/{2000 + r(3, 30)}", f"{r(1, 99)} {r(2, 99)} {r(3, 99)}",
            f"v{r(1, 9)}.{r(2, 99)}", f"{r(1, 90) + 10}-{r(2, 90) + 10}", f"{sixteen[:8]} {sixteen[8:]}", f"#{r(1, 99999)}",
            f"{r(1, 9)}.{r(2, 9)}e-{r(3, 9)}", f"{r(1, 10 ** 10):010d}", f"{r(1, 10 ** 12):012d}")[seed % 18]


def examples(batches):
    """Islands of the corpus as text, with the rules' spans inside them as labels."""
    for b in batches:
        text, gold = [], []
        for t in b.column("text").to_pylist():
            if not t or not _SIGN.search(t):
                continue
            found = rule_spans(t)
            for tokens in islands(t):
                if len(tokens) > MAX_TRAIN_TOKENS or tokens[-1][1] - tokens[0][0] > 2000:
                    continue
                lo, hi = tokens[0][0], tokens[-1][1]
                text.append(t[lo:hi])
                gold.append([f"{k}:{a - lo}:{e - lo}" for k, a, e in found if a >= lo and e <= hi])
        yield pa.RecordBatch.from_arrays([pa.array(text, pa.string()), pa.array(gold, pa.list_(pa.string()))], ["text", "gold"])


def _labelled(text: str, gold: list[tuple[str, int, int]]):
    """Lattice and labels of an island, or None if a label is no candidate."""
    tokens = [m.span() for m in _WORD.finditer(text)]
    lat = lattice(text, tokens)
    number = {span: k for k, span in reversed(list(enumerate(lat.spans)))}
    try:
        return lat, [(KINDS.index(kind), number[a, b]) for kind, a, b in gold]
    except KeyError:
        return None


#: One span of each kind, so that a corpus without any still teaches the forms.
_SEEDS = (("email", "first.last@mail.example.org"), ("ip", "192.0.2.17"), ("card", "4111111111111111"), ("phone", "+1 (555) 555-0100"))


def train(rows: list[tuple[str, list[str]]], epochs: int = 30, penalty: float = 0.02) -> np.ndarray:
    """Weights (kind by feature) from islands and what is made of them."""
    made: list[tuple[str, list[tuple[str, int, int]]]] = []
    for text, gold in rows:
        made.append((text, [(k, int(a), int(b)) for k, a, b in (g.split(":") for g in gold)]))
    seeds = [(k, s) for k, s in _SEEDS for _ in range(12)]
    for text, gold in list(made):
        seeds += [(k, text[a:b]) for k, a, b in gold]
    for n, (kind, s) in enumerate(seeds):
        made.append((f"the {s} of", [(kind, 4, 4 + len(s))]))
        if other := disguised(kind, s, n):
            made.append((f"to {other} and", [(kind, 3, 3 + len(other))]))
    made += [(f"of {look_alike(n)} the", []) for n in range(18 * 12)]
    data = [x for x in (_labelled(*m) for m in made) if x is not None and x[0].bounds]
    w = np.zeros((len(KINDS), len(_FEATURES)))
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    for _ in range(epochs):
        for lo in range(0, len(data), 32):
            part = data[lo : lo + 32]
            g = sum(_gradient(lat, gold, w) for lat, gold in part) / len(part) + penalty * w / 10
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w -= 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-6)
    return w


def fit(docs: DataFrame, text: str = "text", max_islands: int = MAX_TRAIN_ISLANDS) -> np.ndarray:
    """Train on at most `max_islands` distinct islands of the corpus, chosen by hash."""
    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(examples, "text string, gold array<string>")
    found = found.groupBy("text").agg(F.first("gold").alias("gold"))
    rows = found.orderBy(F.xxhash64("text"), "text").limit(max_islands).collect()
    return train(sorted((r["text"], list(r["gold"])) for r in rows))


def find_spans(text: str, weights: np.ndarray) -> tuple[list, list]:
    """Spans of the rules, and those that the field adds."""
    if not text or not _SIGN.search(text):
        return [], []
    base = rule_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    starts = np.array([a for a, _ in taken])
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0)
    added = []
    for tokens in islands(text):
        for kind, a, b in best_spans(lattice(text, tokens), weights):
            k = int(np.searchsorted(starts, b))  # spans that begin before the end
            if k == 0 or ends[k - 1] <= a:
                added.append((kind, a, b))
    return base, added


def _line_up(spans) -> str:
    order = {k: n for n, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (order[x[0]], x[1], x[2])))


def detect(docs: DataFrame, weights: np.ndarray, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns with rule_spans and spans: "kind:start:end" joined by
    commas, by kind as in KINDS and start; spans holds those of the rules and the
    field.  A carried column named like a result gets the prefix ``in_``."""
    carry = docs.columns if carry is None else carry
    names = [f"in_{c}" if c in ("rule_spans", "spans", "_text") else c for c in carry]
    src = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(carry, names, strict=True)), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([f for f in src.schema.fields if f.name != "_text"]).add("rule_spans", "string").add("spans", "string")

    def run(batches):
        for b in batches:
            found = [find_spans(t, weights) for t in b.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array([_line_up(x) for x, _ in found], pa.string()),
                 pa.array([_line_up(x + y) for x, y in found], pa.string())], [*names, "rule_spans", "spans"])

    return src.mapInArrow(run, schema)


def mask(docs: DataFrame, weights: np.ndarray, text: str = "text") -> DataFrame:
    """`docs` with every span of the text replaced by its kind in angle brackets."""
    schema = docs.schema
    names = docs.columns

    def run(batches):
        for b in batches:
            out = []
            for t in b.column(text).to_pylist():
                base, added = find_spans(t, weights)
                last, parts = 0, []
                for kind, a, e in sorted(base + added, key=lambda x: (x[1], -x[2])):
                    if a >= last:
                        parts += [t[last:a], f"<{kind}>"]
                        last = e
                out.append(t if t is None else "".join(parts) + t[last:])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()) if n == text else b.column(n) for n in names], names)

    return docs.mapInArrow(run, schema)


def n_spans(kind: str, spans: str = "rule_spans"):
    """How many spans of a kind a joined list holds."""
    return F.regexp_count(F.col(spans), F.lit(f"{kind}:")).cast("long")
