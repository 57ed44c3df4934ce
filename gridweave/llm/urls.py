"""URL filters: rules by host and path, and logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Block or allow a host with all its subdomains, for paths that begin with ``path``. ``text`` is host and path as written."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


#: The rules of the registered query (fixed values).
RULES = (
    Rule("block", "com/en/"),
    Rule("allow", "example.com/en/7"),
    Rule("allow", "net/de/"),
    Rule("block", "example.net/de/8"),
    Rule("block", "org/es/"),
)
#: Word families of the small labelled table. The rule: a host is labelled to be blocked if it is named after a word that filter lists
#: commonly have for gambling, drugs, adult content, adverts or malicious sites, and not if it is named after an everyday word.
BLOCKED_FAMILIES = "casino poker roulette blackjack jackpot lottery slots betting bookmaker wager pharmacy pills tablets viagra cialis steroids painkiller porn sex xxx nude escort erotic webcam dating adserver adclick banner popunder tracker affiliate clickbait spam phishing malware warez keygen cracks torrent scam payday".split()
ALLOWED_FAMILIES = (
    "news library museum weather garden recipes history science school travel university journal theatre music football cinema hospital council church kitchen river mountain forest farm harbour village railway airport bakery "
    "bicycle camera carpenter chess climate comics computer dentist doctor education energy engineer fashion fishing furniture gallery geology grammar health hotel insurance kindergarten language lawyer literature market "
    "mathematics medicine nature newspaper ocean painting parliament photo physics pottery printing publisher radio restaurant sailing software sport stationery studio swimming tennis tourism translation wikipedia winery wool yoga zoo "
    "essex adulthood betterment pillow bannerman trackside slotted scampi torrential tablecloth"
).split()
#: Words that go with either kind.
_WITH = "online my best the city club shop world live web daily first".split()


def labelled_urls(seed: int = 5, each: int = 10, blocked: Sequence[str] = BLOCKED_FAMILIES, allowed: Sequence[str] = ALLOWED_FAMILIES) -> list[tuple[str, int]]:
    """The labelled table: hosts of every word family under several names, with several paths; 1 is blocked. It has ``each`` rows a word."""
    rng = random.Random(seed)
    out = [("", 0), ("about:blank", 0), ("http://", 0)]
    for label, words in ((1, blocked), (0, allowed)):
        for word in words:
            for _ in range(each):
                name = rng.choice([word, f"{rng.choice(_WITH)}{rng.choice(['', '-'])}{word}", f"{word}{rng.choice(['', '-'])}{rng.choice(_WITH)}", f"{word}{rng.randrange(100)}"])
                host = rng.choice(["", "", "www.", "m.", "a."]) + name + rng.choice(["", "", f".{rng.choice(_WITH)}", f".{''.join(rng.choices('abcdefghiklmnoprstuv', k=7))}"]) + rng.choice([".com", ".net", ".org", ".info", ".co.uk"])
                path = rng.choice(["", "/", "/index.html", f"/item/{rng.randrange(10_000)}", f"/{rng.randrange(2000, 2030)}/{rng.randrange(1, 13)}/about", f"/{''.join(rng.choices('abcdefghiklmnoprstuv', k=5))}", f"/p?q={rng.randrange(99)}"])
                out.append((f"{rng.choice(['http', 'https'])}://{host}{path}", label))
    return out


def parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased) and path (then up to ``?``, ``#`` or the end)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct (size, text, verdict); null if none does. Rules are a short list held in the plan."""
    table = F.array(*[F.struct(F.lit(len(r.text)).alias("size"), F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"), F.lit(r.host).alias("host"), F.lit(r.path).alias("path")) for r in rules])
    fits = lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"])
    return F.array_max(F.transform(F.filter(table, fits), lambda r: F.struct(r["size"], r["text"], r["verdict"])))


def hashed_grams(host: Column, path: Column, size: int, widths: tuple[int, ...]) -> Column:
    """Array of the different bucket numbers (from 1) of all character n-grams, of all ``widths``, of the host, with its ends marked, and the path."""
    text = F.concat(F.lit("^"), host, F.lit("$"), path)
    grams = lambda width: F.transform(
        F.sequence(F.lit(1), F.greatest(F.char_length(text) - (width - 1), F.lit(1))), lambda i: (F.pmod(F.xxhash64(F.substr(text, i, F.lit(width))), F.lit(size)) + 1).cast("int")
    )
    return F.array_distinct(F.concat(*[grams(width) for width in widths]))


@dataclass(frozen=True)
class UrlModel:
    """Weights of the buckets and bias; a URL is blocked where bias plus the sum of its n-grams' weights over the root of their number is above 0."""

    weights: tuple[float, ...]
    bias: float
    widths: tuple[int, ...]


def train(spark: SparkSession, table: list[tuple[str, int]] | None = None, size: int = 8192, widths: tuple[int, ...] = (3, 4, 5), steps: int = 400, rate: float = 8.0, decay: float = 3e-6, margin: float = 1.0) -> UrlModel:
    """Fit on a small labelled table. Its features come from the same expressions as those of all URLs; the table bounds the work.

    Gradient steps with momentum over the whole table run on the driver, both labels with equal weight in all; equal tables give equal
    weights. ``margin`` is then taken from the bias, as most URLs are not to be blocked: names unlike any in the table are allowed.
    """
    rows = labelled_urls() if table is None else table
    host, path = parts(F.col("url"))
    fitted = spark.createDataFrame(rows, "url string, label int").select(hashed_grams(host, path, size, widths).alias("g"), "label").collect()
    label = np.array([r["label"] for r in fitted], np.float64)
    own = np.repeat(np.arange(len(fitted)), [len(r["g"]) for r in fitted])
    gram = np.array([g for r in fitted for g in r["g"]], np.int64)
    scale = 1 / np.sqrt(np.bincount(own, minlength=len(fitted)))
    balance = np.where(label > 0, 0.5 / max(label.sum(), 1.0), 0.5 / max((1 - label).sum(), 1.0))
    weights, speed, bias, drift = np.zeros(size + 1), np.zeros(size + 1), 0.0, 0.0
    for _ in range(steps):
        odds = bias + np.bincount(own, weights[gram], minlength=len(fitted)) * scale
        gap = (label - 1 / (1 + np.exp(-np.clip(odds, -30, 30)))) * balance
        speed = 0.9 * speed + np.bincount(gram, (gap * scale)[own], minlength=size + 1) - decay * weights
        drift = 0.9 * drift + 0.1 * gap.sum()
        weights, bias = weights + rate * speed, bias + rate * drift
    return UrlModel(tuple(weights[1:].tolist()), float(bias) - margin, widths)


def score(host: Column, path: Column, model: UrlModel) -> Column:
    """Log odds that a URL is to be blocked, from its different n-grams."""
    weights = F.split(F.lit(" ".join(map(repr, model.weights))), " ").cast("array<double>")  # one literal, folded when the query is planned
    grams = hashed_grams(host, path, len(model.weights), model.widths)
    total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.element_at(weights, g))
    return F.lit(model.bias) + total / F.sqrt(F.size(grams).cast("double"))


def judged(pages: DataFrame, model: UrlModel, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule`` (text of the longest that fits, else null), ``verdict`` and ``score``.

    The rule decides where there is one, else the model. A null URL or one without ``://`` has empty host and path and is judged by the model.
    Rows are judged one by one: repeated rows get equal results, null ids stay, no rows give no rows, very long URLs are
    judged whole, other columns are not read. Only built-in functions are used.
    """
    host, path = parts(F.col(url_col))
    split = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    ruled = split.withColumn("_rule", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("score", score(F.col("host"), F.col("path"), model))
    own = F.when(F.col("score") > 0, "block").otherwise("allow")
    return ruled.select(id_col, "host", "path", F.col("_rule.text").alias("rule"), F.coalesce(F.col("_rule.verdict"), own).alias("verdict"), "score")
