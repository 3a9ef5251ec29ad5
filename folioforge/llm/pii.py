"""Personal data: fixed patterns, then a skip-chain conditional random field over what looks like them.

Patterns find e-mail addresses, IP addresses, card numbers and phone numbers; a match that fails its
check is dropped and not retried. The field then labels candidates, tokens with an "@" or three digits
and runs of short digit groups, as O, email, ip, card or phone. All other tokens are O and constant, so
leaving them out changes nothing. Neighbouring candidates share a chain potential. Candidates that
repeat, however far apart in the document, share a skip potential: equal tokens, equal last seven digits
whatever stands between them, equal address names. Each is linked to the one before it, the first one, and the first one
in a pattern span with the same key, so links are linear in the tokens. Links to a pattern span have a potential of
their own, which is bounded from below: one certain twin is enough. Loopy sum-product passes messages over all until they settle; a
mention that on its own is doubtful takes the label of its certain twin. A candidate outside all pattern
spans whose marginal reaches ``certain`` is added. That finds what the patterns lose because they run on
into the next number and drop the whole, and short or reformatted mentions of a certain one.

The weights are fitted here, on documents in four languages made up from a seed, by pseudo-likelihood.
Pattern spans always stay. Work is per document: a map without shuffles, linear in the text, also for long runs of
digits or letters. Null texts count as empty. Repeated rows each get their own result.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.llm.common import map_rows, text_of

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Tokens with a digit or an "@".
_CANDIDATE = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+")
_QUAD = re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
#: What a number that is written in groups may consist of.
_GROUPS = re.compile(r"\(?\+?\(?[0-9]{1,4}\)?(?:[.-][0-9]{1,4})*+")
_TRIM = ".,;:!?\"'()[]{}<>"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """An address's name is the whole run before its "@", so only the "@"s are looked at."""
    out, reached, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > reached and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            reached = domain.end()
        elif start < at:
            reached = max(reached, at)
        at = text.find("@", max(at + 1, reached))
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans by kind, each in order of start."""
    emails = _emails(text) if "@" in text else []
    if not _DIGIT.search(text):
        return [emails, [], [], []]
    ips = [m.span() for m in _IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split(".")))]
    cards = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    phones = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m[0])) <= 15] if "+" in text else []
    return [emails, ips, cards, phones]


# ---------------------------------------------------------------- the field


def candidates(text: str) -> list[tuple[int, int]]:
    """Trimmed tokens with an "@" or three digits; tokens of short digit groups a space apart are one, with seven digits or more."""
    out: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []

    def close():
        digits = [len(_DIGIT.findall(text[a:b])) for a, b in run]
        if len(run) > 1 and 7 <= sum(digits) <= 19:
            out.append((run[0][0], run[-1][1]))
        else:
            out.extend(span for span, n in zip(run, digits, strict=True) if n >= 3)
        run.clear()

    for m in _CANDIDATE.finditer(text):
        token = m[0]
        start = m.start() + len(token) - len(token.lstrip(_TRIM if token[0] != "(" else ""))
        end = m.start() + len(token.rstrip(_TRIM if token[-1] != ")" else ""))
        if end <= start:
            continue
        bare = text[start:end]
        grouped = bool(_GROUPS.fullmatch(bare)) and not _QUAD.fullmatch(bare)
        if run and not (grouped and start == run[-1][1] + 1):
            close()
        if grouped:
            run.append((start, end))
            if end < m.end():
                close()
        elif "@" in token or len(_DIGIT.findall(token)) >= 3:
            start, end = m.start() + len(token) - len(token.lstrip(_TRIM)), m.start() + len(token.rstrip(_TRIM))
            if end > start:
                out.append((start, end))
    close()
    return out


#: Words before a value that say what it is, in the four languages of the training texts.
_SAYS = {
    "phone": r"tel|phone|call|fax|mobile|dial|telefon|anrufen|mobil|rufnummer|téléphone|appelez|appeler|portable|teléfono|llame|llamar|móvil",
    "card": r"card|visa|payment|karte|kartennummer|zahlung|carte|paiement|tarjeta|pago",
    "ip": r"ip|host|server|address|adresse|rechner|serveur|hôte|servidor|dirección",
    "email": r"mail|email|e-mail|contact|kontakt|courriel|correo|contacto",
}
_BEFORE = {kind: re.compile(rf"\b(?:{words})\b[^\w]*(?:\w{{1,6}}[^\w]+)?$") for kind, words in _SAYS.items()}
_DATE = re.compile(r"[0-9]{1,4}[-./][0-9]{1,2}[-./][0-9]{1,4}")
FEATURES = 31


def features(text: str, spans: list[tuple[int, int]], covered: np.ndarray) -> np.ndarray:
    """covered: per candidate the kind of a base span over it, 0 for none."""
    x = np.zeros((len(spans), FEATURES))
    for i, (a, b) in enumerate(spans):
        token = text[a:b]
        figures = "".join(_DIGIT.findall(token))
        digits = len(figures)
        dots = token.count(".")
        before = text[max(0, a - 32) : a].lower()
        quad = _QUAD.match(token)
        numeric = digits > 0 and not any(c.isalpha() for c in token)
        x[i, 0] = 1
        x[i, 1 + int(covered[i])] = 1
        x[i, 6] = "@" in token
        x[i, 7] = "@" in token and "." in token.rpartition("@")[2]
        x[i, 8] = digits == len(token)
        x[i, 9] = quad is not None and all(int(p) <= 255 for p in quad[0].split("."))
        x[i, 10] = quad is not None
        x[i, 11] = numeric and 16 <= digits <= 19 and luhn(figures)
        x[i, 12] = numeric and 16 <= digits <= 19
        x[i, 13] = numeric and 8 <= digits <= 15
        x[i, 14] = numeric and digits == 7
        x[i, 15] = digits <= 4
        x[i, 16] = not numeric
        x[i, 17] = a > 0 and text[a - 1] == "("
        x[i, 18] = numeric and token[0] == "+"
        x[i, 19] = numeric and token[0] == "+" and 8 <= digits <= 15
        x[i, 20] = bool(re.search(r"\+[0-9 ().-]*$", before))
        for k, kind in enumerate(KINDS):
            x[i, 21 + k] = bool(_BEFORE[kind].search(before))
        x[i, 25] = "/" in token or ":" in token
        x[i, 26] = numeric and dots in (1, 2)
        x[i, 27] = bool(_DATE.fullmatch(token))
        x[i, 28] = numeric and (" " in token or "(" in token)
        x[i, 29] = numeric and x[i, 21 + KINDS.index("phone")] and 7 <= digits <= 15
        x[i, 30] = digits > 19
    return x


def keys_of(token: str) -> list[str]:
    """What repeated or similar tokens have in common."""
    token = token.lower()
    out = [token]
    digits = "".join(_DIGIT.findall(token))
    if len(digits) >= 7:
        out.append(f"#{digits[-7:]}")
    if "@" in token:
        out.append(f"@{token.partition('@')[0]}")
    return out


#: What a link to a pattern span of a kind adds at least to the log odds of that kind against O.
TWIN = 10.0


def edges(text: str, spans: list[tuple[int, int]], cover: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chain, free, anchored) pairs of candidate indexes: neighbours, alike with none in a pattern span, alike with one or both."""
    chain = [(i, i + 1) for i in range(len(spans) - 1) if spans[i + 1][0] - spans[i][1] <= 3]
    ends: dict[str, tuple[int, int, int | None]] = {}  # the first, the last and the first certain candidate with a key
    skip = set()
    for i, (a, b) in enumerate(spans):
        for key in keys_of(text[a:b]):
            first, last, sure = ends.get(key, (i, i, None))
            skip |= {(k, i) for k in (first, last, sure) if k is not None and k != i}
            if cover[i] and sure is None:
                skip |= {(first, i)} if first != i else set()
                sure = i
            ends[key] = first, i, sure
    parts = [sorted(e for e in skip if bool(cover[e[0]] or cover[e[1]]) == sure) for sure in (False, True)]
    return tuple(np.array(p, dtype=np.int64).reshape(-1, 2) for p in (chain, *parts))


def propagate(unary: np.ndarray, pairs: np.ndarray, tables: np.ndarray, *, rounds: int = 30, damping: float = 0.3) -> np.ndarray:
    """Marginals by loopy sum-product. tables[e][a, b] is the log potential of edge e = (u, v) with labels a, b."""
    n, k = unary.shape
    if len(pairs):
        source = np.concatenate((pairs[:, 0], pairs[:, 1]))
        target = np.concatenate((pairs[:, 1], pairs[:, 0]))
        table = np.concatenate((tables, tables.transpose(0, 2, 1)))
        back = np.concatenate((np.arange(len(pairs)) + len(pairs), np.arange(len(pairs))))
        message = np.zeros((len(source), k))
        for _ in range(rounds):
            belief = unary.copy()
            np.add.at(belief, target, message)
            out = (belief[source] - message[back])[:, :, None] + table
            top = out.max(axis=1, keepdims=True)
            new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            new -= new.max(axis=1, keepdims=True)
            moved = np.abs(new - message).max()
            message = damping * message + (1 - damping) * new
            if moved < 1e-4:
                break
        unary = unary.copy()
        np.add.at(unary, target, message)
    p = np.exp(unary - unary.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _cover(spans: list[tuple[int, int]], base: list[list[tuple[int, int]]]) -> np.ndarray:
    """Kind (1..4) of a base span that overlaps each candidate, 0 for none."""
    out = np.zeros(len(spans), dtype=np.int64)
    starts = np.array([a for a, _ in spans])
    ends = np.array([b for _, b in spans])
    for kind in range(len(KINDS), 0, -1):
        for a, b in base[kind - 1]:
            first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b)
            out[first:last] = kind
    return out


_WORDS = (
    "the order came with note from last week and we sent it to them again about room plan near old river",
    "der bericht kam mit einer notiz von letzter woche und wir haben ihn wieder an das alte haus am fluss geschickt",
    "le rapport est venu avec une note de la semaine passée et nous avons envoyé tout cela vers la vieille maison",
    "el informe llegó con una nota de la semana pasada y lo mandamos otra vez a la casa vieja cerca del río",
)
_LEADS = (
    {"phone": ("call", "phone:", "tel.", "dial"), "card": ("card", "visa number", "payment"), "ip": ("host", "server", "ip"), "email": ("mail", "contact:")},
    {"phone": ("telefon", "mobil:", "rufnummer"), "card": ("karte", "kartennummer:"), "ip": ("rechner", "server"), "email": ("kontakt", "e-mail:")},
    {"phone": ("appelez le", "téléphone :"), "card": ("carte", "paiement"), "ip": ("serveur", "hôte"), "email": ("courriel", "contact :")},
    {"phone": ("llame al", "teléfono:", "móvil"), "card": ("tarjeta", "pago"), "ip": ("servidor", "dirección"), "email": ("correo", "contacto:")},
)


def _values(rng: np.random.Generator) -> list[list[tuple[str, str]]]:
    """Groups of (value, kind) that stand in one text, some of them mentions of one thing; a bar cuts a value into
    neighbours, each with its kind."""
    number = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    first = lambda n: f"{rng.integers(1, 10)}{number(n - 1)}"

    def card() -> str:
        body = f"4{number(14)}"
        return next(body + c for c in "0123456789" if luhn(body + c))

    quad = lambda: ".".join(str(v) for v in rng.integers(0, 256, 4))
    fours = lambda s, by: by.join(s[k : k + 4] for k in range(0, 16, 4))
    tail, name = f"{first(3)}-{number(4)}", "".join(rng.choice(list("abcdefghklmnorst"), 6))
    area, spain = first(3), [first(3), number(3), number(3)]
    us, es = f"+1 ({area}) {tail}", f"+34 {' '.join(spain)}"
    de = [first(3), first(7)]
    one, two = card(), card()
    wrong = one[:-1] + str((int(one[-1]) + 1 + int(rng.integers(0, 9))) % 10)
    other = first(16)
    return [
        [(us, "phone"), (tail, "phone"), (f"({area}) {tail}", "phone")],
        [(es, "phone"), ("".join(spain), "phone"), (" ".join(spain), "phone"), ("-".join(spain), "phone")],
        [(f"+49 {de[0]} {de[1]}", "phone"), (f"0{de[0]}-{de[1]}", "phone"), (de[1], "phone")],
        [(f"{us}|{quad()}", "phone|ip")],
        [(f"{us}|{two}", "phone|card"), (two, "card")],
        [(f"{one}|{two}", "card|card"), (one, "card"), (fours(two, "-"), "card")],
        [(f"{one}|{one}", "card|card")],
        [(f"{two}|{other}", "card|" + ("card" if luhn(other) else "O"))],
        [(fours(one, " "), "card"), (one, "card")],
        [(wrong, "O"), (wrong, "O")] if not luhn(wrong) else [],
        [(first(16) + number(int(rng.integers(4, 12))), "O")],
        [(f"{name[:4]}{number(2)}@localhost", "O")],
        [(f"{name}@mail.example.org", "email"), (f"{name}@intranet", "email")],
        [(quad(), "ip"), (quad() + ":8080", "ip")],
        [(f"{first(3)}-{number(4)}", "O")],
        [(f"{rng.integers(1900, 2030)}-{rng.integers(10, 13)}-{rng.integers(10, 29)}", "O"), (f"{rng.integers(1900, 2030)}", "O")],
        [(f"{rng.integers(10, 29)}.{rng.integers(10, 13)}.{rng.integers(1900, 2030)}", "O")],
        [(number(int(rng.integers(3, 12))), "O")],
        [(f"{first(3)} {number(3)} {number(3)}", "O")],
        [(f"{number(1)}.{number(2)}.{number(3)}", "O"), (f"{rng.integers(256, 999)}.{number(3)}.{number(3)}.{number(3)}", "O")],
        [(f"{first(2)},{number(3)}.{number(2)}", "O"), (f"{number(3)}/{number(5)}", "O")],
        [("".join(rng.choice(list("0123456789abcdef"), 32)), "O")],
    ]


def made_up(seed: int, n: int):
    """Documents made up from a seed: (text, spans of the candidates, their base kinds, their labels)."""
    rng = np.random.default_rng(seed)
    for _ in range(n):
        language = int(rng.integers(0, len(_WORDS)))
        words, leads = _WORDS[language].split(), _LEADS[language]
        groups = _values(rng)
        parts: list[tuple[str, str]] = []
        for g in rng.permutation(len(groups))[: rng.integers(1, 7)]:
            own = groups[g]
            parts += own[: 1 if rng.random() < 0.25 else rng.integers(1, len(own) + 1)] if own else []
        text, marks = "", []
        for at in rng.permutation(len(parts)):
            value, kind = parts[at]
            text += " ".join(rng.choice(words, rng.integers(3, 9))) + " "
            said = kind.partition("|")[0]
            if rng.random() < 0.35:
                text += str(rng.choice(leads[said if said in leads else str(rng.choice(KINDS))] if rng.random() < 0.9 or said != "O" else words)) + " "
            for v, k in zip(value.split("|"), kind.split("|"), strict=True):
                marks.append((len(text), len(text) + len(v), k))
                text += v + " "
            if rng.random() < 0.3:
                text = text[:-1] + str(rng.choice([". ", ", ", "; "]))
        spans = candidates(text)
        cover = _cover(spans, base_spans(text))
        labels = np.zeros(len(spans), dtype=np.int64)
        for i, (a, b) in enumerate(spans):
            kind = next((k for s, e, k in marks if s < b and a < e), "O")
            labels[i] = cover[i] or LABELS.index(kind)
        yield text, spans, cover, labels


@lru_cache(maxsize=1)
def fitted() -> tuple[np.ndarray, np.ndarray]:
    """(weights, tables of chain, free and anchored links) by pseudo-likelihood: each label given its neighbours' labels."""
    k = len(LABELS)
    xs, ys, near = [], [], []
    for text, spans, cover, labels in made_up(5, 1_500):
        counts = np.zeros((len(spans), 3 * k))
        for which, pairs in enumerate(edges(text, spans, cover)):
            for u, v in pairs:
                counts[u, which * k + labels[v]] += 1
                counts[v, which * k + labels[u]] += 1
        xs.append(features(text, spans, cover))
        ys.append(labels)
        near.append(counts)
    x, y, c = np.concatenate(xs), np.concatenate(ys), np.concatenate(near)
    one = np.eye(k)[y]
    w, t = np.zeros((FEATURES, k)), np.zeros((3 * k, k))
    for _ in range(1_000):
        z = x @ w + c @ t
        p = np.exp(z - z.max(axis=1, keepdims=True))
        miss = one - p / p.sum(axis=1, keepdims=True)
        w += 2.0 * (x.T @ miss / len(x) - 1e-5 * w)
        t += 2.0 * (c.T @ miss / len(x) - 1e-5 * t)
    tables = t.reshape(3, k, k)
    tables = (tables + tables.transpose(0, 2, 1)) / 2
    for kind in range(1, k):
        tables[2, kind, kind] = max(tables[2, kind, kind], tables[2, 0, kind] + TWIN)
    return w, tables


def find(text: str, model, certain: float = 0.85) -> tuple[list[list[tuple[int, int]]], list[list[tuple[int, int]]]]:
    """(base spans, all spans) by kind."""
    base = base_spans(text)
    spans = candidates(text)
    if not spans:
        return base, base
    cover = _cover(spans, base)
    if cover.all():
        return base, base
    weights, potentials = model
    links = edges(text, spans, cover)
    pairs = np.concatenate(links)
    tables = np.repeat(potentials, [len(p) for p in links], axis=0)
    marginal = propagate(features(text, spans, cover) @ weights, pairs, tables)
    both = [list(b) for b in base]
    for i in np.flatnonzero((cover == 0) & (marginal.argmax(axis=1) > 0) & (marginal.max(axis=1) >= certain)):
        both[marginal[i].argmax() - 1].append(spans[i])
    return base, [sorted(b) for b in both]


def joined(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, own in zip(KINDS, spans, strict=True) for a, b in own)


def find_personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", certain: float = 0.85) -> DataFrame:
    """id, n_<kind> of the base spans, base_sha256, spans (base and added), n_added for every row."""
    model = fitted()

    def row(text: str):
        base, both = find(text, model, certain)
        line = joined(base)
        return *map(len, base), hashlib.sha256(line.encode()).hexdigest(), joined(both), sum(map(len, both)) - sum(map(len, base))

    bare = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    found = map_rows(bare, ["id"], lambda: lambda texts: list(zip(*map(row, texts))), f"{kinds}, base_sha256 string, spans string, n_added long")
    return found.withColumnRenamed("id", id_col)
