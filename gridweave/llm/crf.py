"""Skip-chain conditional random field over tokens, with loopy belief propagation; trained on generated sentences."""

from __future__ import annotations

import random
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

LABELS = ("other", "email", "ip", "card", "phone", "secret")
SPACES = " \t\n\v\f\r"
#: Words that announce a kind, in English, German, French and Spanish.
CUES = {
    1: "password passwd pwd passphrase pin passwort kennwort passe contraseña clave",
    2: "token key secret apikey api_key credential bearer schlüssel geheimnis jeton clé secreto",
    3: "phone call tel telephone fax mobile cell telefon handy anruf rufnummer téléphone appelez portable teléfono llame móvil",
    4: "card visa mastercard iban account karte konto carte compte tarjeta cuenta",
    5: "ip host address server rechner serveur hôte servidor",
    6: "mail email e-mail contact mailto kontakt courriel correo contacto",
}
_CUE = {word: kind for kind, words in CUES.items() for word in words.split()}
_EDGE = ".,;:!?\"'()[]{}<>#*$%&|=`"
_HEX = re.compile(r"[0-9a-fA-F]{20,}")
_MIX = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9_+/=-]{8,}")
_DOTTED = re.compile(r"[0-9]{1,3}(\.[0-9]{1,3}){3}")
_PHONE = re.compile(r"\+?[0-9()][0-9()./-]*+")
_GROUPS = re.compile(r"[0-9]++(?:[.,:/-][0-9]++)++")
_DATE = re.compile(r"(?:19|20)[0-9]{2}([./-][0-9]{1,2}){1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:(?:19|20)[0-9]{2}|[0-9]{2})")
#: A word that follows the name of a secret and a sign of assignment is a candidate, whether it has a digit or not.
_GIVEN = re.compile(r"(?i)\b(?:" + "|".join(w for kind in (1, 2) for w in CUES[kind].split()) + r")[ ]?[=:][ ]?([^\x20\x09-\x0D]+)")
#: A name and a sign of assignment in front of a value in one word.
_NAMED = re.compile(r"[\"'({\[]?[^\W\d_][^\W\d-]*+(?:-[^\W\d]++)*+[\"']?[=:]")


@dataclass(frozen=True)
class Token:
    """A candidate: its place in the text, what stands before it, whether its form was seen before in the text."""

    start: int
    end: int
    text: str
    before: str
    touches: bool  # only spaces lie between the candidate before and this one
    form: str  # without case, punctuation and separators; empty where it is too short to be known again
    again: bool


def _starts(text: str) -> Iterator[int]:
    """Where words with a digit or ``@`` begin (less a name and ``=`` or ``:`` before it), and words given as a secret, wherever these stand."""
    done = 0
    for m in re.finditer(r"[0-9@][^\x20\x09-\x0D]*", text):
        if (at := m.start()) >= done:
            while at > done and text[at - 1] not in SPACES:
                at -= 1
            named = _NAMED.match(text, at, m.start())
            yield named.end() if named else at
            done = m.end()
    given = {m[1].strip(_EDGE) for m in _GIVEN.finditer(text)}
    given = {w for w in given if len(w) >= 4 and not any(c.isdigit() or c == "@" for c in w)}
    if given:
        for m in re.finditer(r"[^\x20\x09-\x0D=:]+", text):
            if m.group().strip(_EDGE) in given:
                yield m.start()


def candidates(text: str) -> list[Token]:
    """Words of a text that hold a digit or ``@`` or are given as a secret somewhere, in order. Every other word is ``other`` with certainty."""
    out: list[Token] = []
    seen: set[str] = set()
    done = 0
    word = re.compile(r"[^\x20\x09-\x0D]*")
    for at in sorted(set(_starts(text))):
        if at < done:
            continue
        end = word.match(text, at).end()
        own = text[at:end]
        form = re.sub(r"[^\w@]|_", "", own.lower())
        form = form if len(form) >= 4 else ""
        out.append(Token(at, end, own, text[max(done, at - 48) : at], bool(out) and not text[done:at].strip(SPACES), form, form in seen and bool(form)))
        seen.add(form)
        done = end
    return out


def features(token: Token) -> list[int]:
    """Numbers of the features that hold for a token.

    What a form looks like counts where it stands for the first time; where it comes again, only what names it there does. So a thing
    that is mentioned often is judged by its looks once and by all that is said of it, and no number of mentions adds up.
    """
    cues = {_CUE[w] for w in re.findall(r"[^\W\d]+(?:-[^\W\d]+)*", token.before.lower())[-3:] if w in _CUE}
    given = re.search(r"[=:]\s*[\"']?$", token.before) or token.text[:1] in "=:"
    out = [NEUTRAL if token.again else 0]
    out += [1 + kind for kind in sorted(cues)]  # 2 to 7
    if given:
        out.append(8)
        out += [8 + kind for kind in sorted(cues) if kind < 3]  # 9, 10
    core = token.text.strip(_EDGE)
    digits = sum("0" <= c <= "9" for c in core)
    plain = digits == len(core) > 0
    if token.again:
        return out
    out += [11] if core.count("@") == 1 and "." in core.partition("@")[2].strip(".") and core[0] != "@" else [12] if "@" in core else []
    out += [13] if _DOTTED.fullmatch(core) else []
    if plain:
        out.append(14 + (0 if digits < 4 else 1 if digits == 4 else 2 if digits < 7 else 3 if digits < 13 else 4 if digits < 20 else 5))  # 14 to 19
    elif _HEX.fullmatch(core):
        out.append(20)
    elif _MIX.fullmatch(core):
        out.append(21)
    elif not digits and "@" not in core:
        out.append(22)
    grouped = bool(_GROUPS.fullmatch(core)) and not _DOTTED.fullmatch(core)
    if _PHONE.fullmatch(core) and not plain and not grouped:
        out.append(23)
    out += [24] if token.text.startswith("+") or token.before.rstrip(SPACES).endswith("+") else []
    out += [25] if "(" in token.text or ")" in token.text else []
    if grouped:
        sizes = tuple(len(g) for g in re.split(r"[.,:/-]", core)) if len(core) < 24 else ()
        date = bool(_DATE.fullmatch(core))
        out.append(26 if date else 27 if sizes == (3, 4) else 28 if sizes == (3, 3, 4) else 29 if core[0] == "0" and 7 <= digits <= 12 and sizes[-1:] > (2,) else 30 if sizes == (4, 4, 4, 4) else 31 if 7 <= digits <= 15 else 32)
    out += [33] if token.text[:1] in "\"'" else []
    out += [34] if len(core) >= 24 else [35] if len(core) >= 12 else [36] if len(core) >= 8 else [37]
    out += [38] if digits * 2 < len(core) else []
    bare = core.replace("-", "")
    if 13 <= digits <= 19 and bare.isascii() and bare.isdigit():
        out.append(39 if luhn(bare) else 40)
    return out


N_FEATURES = 41
#: The feature of a form that comes again: its weights stay zero, so mentions alone say nothing.
NEUTRAL = 1


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number holds."""
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(v * 2 - 9 * (v > 4) for v in values[1::2])) % 10 == 0


@dataclass(frozen=True)
class Graph:
    """Tokens of some texts: the features of each (``flat``, from ``starts``), and edges in both directions, each next to its reverse.

    The first ``chains`` edges are chain edges, forward ones at even places; the others are skip edges.
    """

    flat: np.ndarray
    starts: np.ndarray
    source: np.ndarray
    target: np.ndarray
    chains: int


def graph(texts: Iterable[list[Token]]) -> Graph:
    """Chain edges join neighbouring candidates; skip edges join each candidate to the first one of its text with the same form.

    The first mention is the centre of a star, so any mention is two steps from any other and the edges are linear in the tokens.
    """
    flat, starts, chain, skip = [], [], [], []
    n = 0
    for tokens in texts:
        first: dict[str, int] = {}
        for token in tokens:
            starts.append(len(flat))
            flat.extend(features(token))
            if token.touches:
                chain.append((n - 1, n))
            if token.form and first.setdefault(token.form, n) != n:
                skip.append((first[token.form], n))
            n += 1
    pairs = np.array(chain + skip, np.int64).reshape(-1, 2)
    return Graph(np.array(flat, np.int64), np.array(starts, np.int64), pairs.ravel(), pairs[:, ::-1].ravel(), 2 * len(chain))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # features x labels
    chain: np.ndarray  # label before x label after
    skip: np.ndarray  # one strength for all labels to agree, so that mentions about which nothing is known favour none


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def beliefs(model: Model, g: Graph, rounds: int = 12, damp: float = 0.3, pairs: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Log marginals of tokens and, if asked for, of edges (source label x target label) by loopy belief propagation.

    Messages are computed for some edges at a time, so memory is a few numbers for each label of a token and an edge.
    """
    k = len(LABELS)
    local = np.add.reduceat(model.weights[g.flat], g.starts) if len(g.starts) else np.zeros((0, k))
    edges = len(g.source)
    reverse = np.arange(edges) ^ 1
    groups = [(np.arange(0, g.chains, 2), model.chain), (np.arange(1, g.chains, 2), model.chain.T), (np.arange(g.chains, edges), model.skip)]
    steps = [(which[at : at + 16_384], table) for which, table in groups for at in range(0, len(which), 16_384)]
    sent = np.zeros((edges, k))
    total = local.copy()
    for _ in range(rounds if edges else 0):
        before = sent
        sent = np.empty_like(before)
        for which, table in steps:
            new = _sum_exp((total[g.source[which]] - before[reverse[which]])[:, :, None] + table, 1)
            new -= _sum_exp(new, 1)[:, None]
            sent[which] = damp * before[which] + (1 - damp) * new
        total = local.copy()
        np.add.at(total, g.target, sent)
    nodes = total - _sum_exp(total, 1)[:, None] if len(total) else total
    if not pairs:
        return nodes, None
    both = np.empty((edges, k, k))
    for which, table in steps:
        both[which] = (total[g.source[which]] - sent[reverse[which]])[:, :, None] + table + (total[g.target[which]] - sent[which])[:, None, :]
    return nodes, both - _sum_exp(both.reshape(edges, k * k), 1)[:, None, None] if edges else both


def decode(model: Model, texts: list[list[Token]], most: int = 20_000) -> list[list[int]]:
    """Most probable label of each token. One graph holds texts of about ``most`` tokens in all, or one text that has more."""
    out: list[list[int]] = []
    some: list[list[Token]] = []
    for k, tokens in enumerate(texts):
        some.append(tokens)
        if k + 1 == len(texts) or sum(map(len, some)) + len(texts[k + 1]) > most:
            best = beliefs(model, graph(some))[0].argmax(1) if any(some) else np.zeros(0, np.int64)
            ends = np.cumsum([len(t) for t in some])
            out += [best[e - len(t) : e].tolist() for e, t in zip(ends, some)]
            some = []
    return out


def sentences(n: int, seed: int) -> list[tuple[str, list[int]]]:
    """Generated texts and the label of each candidate: personal data and secrets, named or evident and then mentioned again, and
    numbers, names and codes that are none, mentioned as often.
    """
    rng = random.Random(seed)
    one, chance = rng.choice, rng.random
    digits = lambda k: "".join(one("0123456789") for _ in range(k))
    letters = lambda k, of="abcdefghilmnoprstuvz": "".join(one(of) for _ in range(k))
    word = lambda: letters(rng.randint(2, 9))
    mixed = lambda k: "".join(one("abcdefghkmnpqrstuvwxyzABCDEFGHKMNPQ23456789") for _ in range(k - 2)) + one("abcxyz") + digits(1)
    cue = lambda kind: one(CUES[kind].split())
    mark = lambda: one([" = ", " : ", "=", ": ", ":", ' = "', '="', ": '"])
    hexes = lambda: "".join(one("0123456789abcdef") for _ in range(one([24, 32, 40, 64]) - 1)) + digits(1)
    name = lambda: one([word().title() + digits(rng.randint(1, 4)) + one(["", word().title()]), letters(2, "ABCDEGKMPRTX") + digits(rng.randint(2, 4)) + "-" + digits(2) + letters(1, "ABX"), letters(3, "GHKPRTX") + digits(4) + word().title(), mixed(rng.randint(8, 14)), hexes(), f"{word()}{digits(2)}"])

    def card() -> str:
        number = digits(15)
        return next(number + d for d in "0123456789" if luhn(number + d))

    def split(number: str) -> str:
        return "-".join(number[i : i + 4] for i in range(0, 16, 4))

    def thing() -> tuple[str, str, int]:
        """What stands before, what is said, and its label."""
        pick = rng.randrange(26)
        if pick == 0:
            return one(["", "", f"{cue(6)} ", f"{cue(6)}: "]), f"{word()}.{digits(2)}@{word()}{one(['', digits(1)])}.{word()}.{one(['com', 'org', 'net'])}", 1
        if pick == 1:
            return "", f"{word()}@{word()}.{one(['com', 'de'])}", 1
        if pick == 2:
            return (f"{cue(6)} ", f"{word()}@{word()}", 1) if chance() < 0.5 else ("", f"@{word()}", 0)
        if pick in (3, 4):
            return one(["", f"{cue(5)} "]), ".".join(str(rng.randrange(1, 300)) for _ in range(4)), 2
        if pick in (5, 6):
            number = card() if chance() < 0.5 else digits(16)
            return one(["", f"{cue(4)} "]), one([number, split(number)]), 3 if luhn(number) else 0
        if pick in (7, 8):
            return one(["", f"{cue(3)} "]), f"+{digits(rng.randint(1, 2))} {one([f'({digits(3)}) {digits(3)}-{digits(4)}', f'{digits(3)} {digits(6)}', f'{digits(1)} {digits(2)} {digits(2)} {digits(2)} {digits(2)}', f'{digits(3)}-{digits(3)}-{digits(4)}'])}", 4
        if pick == 9:
            return "", one([f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(3)}-{digits(4)}", f"{digits(3)}.{digits(3)}.{digits(4)}"]), 4
        if pick == 10:
            return f"{cue(3)}{one([' ', ': '])}", one([f"{digits(3)}-{digits(4)}", digits(rng.randint(7, 11)), f"0{digits(2)}/{digits(7)}", f"0{digits(3)}-{digits(6)}"]), 4
        if pick in (11, 12):
            return cue(one([1, 2])) + mark(), one([hexes(), mixed(rng.randint(8, 16))]), 5
        if pick == 13:
            return f"{cue(1)} ", mixed(rng.randint(8, 14)), 5
        if pick == 14:
            return one([f"pin {one(['', '= ', ': '])}", f"{cue(1)}{mark()}"]), digits(rng.randint(4, 8)), 5
        if pick == 15:
            return one([(cue(1) + mark(), letters(rng.randint(6, 14)), 5), (cue(2) + one(["=", " = ", '="']), letters(rng.randint(10, 20)), 5), (cue(2) + one([": ", " : "]), word(), 0), (cue(2) + ": ", word(), 0)])
        if pick in (16, 17, 18, 19):
            return "", name(), 0
        if pick == 20:
            return "", one([f"{one(['19', '20'])}{digits(2)}", f"20{digits(2)}-{digits(2)}-{digits(2)}", f"{digits(2)}.{digits(2)}.20{digits(2)}", f"{digits(2)}/{digits(2)}/20{digits(2)}"]), 0
        if pick == 21:
            return "", one([f"{digits(1)}.{digits(1)}.{digits(2)}", f"{digits(2)}.{digits(2)}", f"{digits(1)},{digits(3)}", f"v{digits(1)}.{digits(1)}", f"{digits(2)}:{digits(2)}", f"{digits(1)}.{digits(1)}.{digits(1)}.{word()}"]), 0
        if pick == 22:
            return one(["", "order ", "item ", "no. ", "isbn "]), one([digits(rng.randint(5, 12)), f"978-{digits(1)}-{digits(3)}-{digits(5)}-{digits(1)}", f"{digits(3)}-{digits(4)}", f"{digits(5)}-{digits(4)}"]), 0
        if pick == 23:
            return "", f"{one(['http', 'https'])}://{word()}.{one(['com', 'de'])}{one(['', f':{digits(4)}'])}/{word()}{one(['/', '?id=', '?key=', '#'])}{digits(rng.randint(1, 9))}", 0
        return "", digits(rng.randint(1, 5)), 0

    out = []
    for _ in range(n):
        text, spans, told = "", [], []
        for _ in range(rng.randint(3, 14)):
            text += " ".join(word() for _ in range(rng.randint(1, 9))) + " "
            before, said, label = one(told) if told and chance() < 0.3 else thing()
            times = rng.randint(2, 12) if not label and not before and chance() < 0.15 else 1
            for k in range(times):
                text += before if not k else " ".join(word() for _ in range(3)) + " "
                spans.append((len(text), len(text) + len(said), label))
                text += said + ("\"'"[before[-1:] == "'"] if before[-1:] in ("'", '"') and before else "") + one(["", "", ".", ",", "!!", "%%%"]) + " "
            told.append(("", said, label))
        tokens = candidates(text)
        out.append((text, [next((label for a, b, label in spans if a <= t.end - 1 and t.start < b), 0) for t in tokens]))
    return out


@lru_cache(maxsize=4)
def train(n: int = 600, seed: int = 7, steps: int = 90, rate: float = 0.5, decay: float = 3e-4) -> Model:
    """Fit by gradient ascent on the likelihood, with marginals from belief propagation. ``n`` generated texts bound the work."""
    made = sentences(n, seed)
    g = graph([candidates(text) for text, _ in made])
    truth = np.concatenate([np.array(labels, np.int64) for _, labels in made])
    k = len(LABELS)
    gold = np.eye(k)[truth]
    owner = np.repeat(np.arange(len(g.starts)), np.diff([*g.starts, len(g.flat)]))
    here, there = g.source[::2], g.target[::2]
    gold_pair = gold[here][:, :, None] * gold[there][:, None, :]
    skips = np.arange(len(here)) >= g.chains // 2
    model = Model(np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.zeros((k, k)))
    speed = [np.zeros_like(x) for x in (model.weights, model.chain, model.skip)]
    for _ in range(steps):
        nodes, pair = beliefs(model, g, rounds=5, pairs=True)
        off = gold - np.exp(nodes)
        unary = np.zeros((N_FEATURES, k))
        np.add.at(unary, g.flat, off[owner])
        unary[NEUTRAL] = 0.0
        gap = gold_pair - np.exp(pair[::2])
        skip = gap[skips].sum(0)
        grads = (unary, gap[~skips].sum(0), np.eye(k) * np.trace(skip) / k)
        parts = []
        for i, (now, grad) in enumerate(zip((model.weights, model.chain, model.skip), grads)):
            speed[i] = 0.9 * speed[i] + grad / n - decay * now
            parts.append(now + rate * speed[i])
        model = Model(*parts)
    return model
