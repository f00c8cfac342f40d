"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

A URL's host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case; its path goes on to ``?``, ``#`` or the end. The rule that fits with the
longest host and path gives the verdict; URLs without a rule get the model's.

Features: n-grams of ``GRAMS`` code points of the host and, apart from them, of the
path, each between two marks and with A-Z in lower case; digits of a path count as one and the same digit, as
page numbers say nothing. A gram is hashed to one of ``DIM`` features; a
feature counts once for each occurrence, and a URL's vector has length one, so long URLs
weigh no more than short ones.

The model is fitted on a small table of labelled URLs, ``labelled_urls`` unless another is
given, of which at most ``SAMPLE`` distinct URLs are taken, those with the
smallest digests. With few rows and many features the ridge-penalised fit is done on the
rows' inner products (Newton steps); the weights follow from it. Both labels weigh alike.

Defined cases: a URL that is null or without ``://`` has an empty host and path, fits no rule and is judged by
the model, which sees the two marks only; a rule of a host fits the host itself and all its
subdomains, and its path is a prefix of the URL's, so a URL without a path fits no rule; of rules of equal
length the one with the longer host wins, then the smaller; a labelled URL with both labels counts as blocked; without
labels of both kinds the score is the share of blocked labels, or 0; repeated rows get equal
results; an empty table gives an empty result. Extra columns are kept by ``judged`` unless
they have the name of a result, which replaces them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import mixed

#: Features, lengths of n-grams, labelled URLs of a fit at most, the penalty on weights.
DIM, GRAMS, SAMPLE, RIDGE = 1 << 18, (2, 3, 4), 2_000, 0.001
#: A score from which on a URL is blocked.
THRESHOLD = 0.5
#: Code points whose n-grams are worked out at once.
TOGETHER = 1 << 19
ADDED = ("host", "path", "rule", "verdict", "score")


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the URLs of ``host`` and its subdomains whose path begins with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    def __post_init__(self) -> None:
        if self.verdict not in ("allow", "block") or not self.host:
            raise ValueError("a rule needs allow or block, and a host")


# --- Fixed values: the production rules, and the small table of labelled URLs (1: to block). ---
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
#: Site names and page names of the labelled table, to block and to allow.
BLOCKED_NAMES = """
    casino-royal best-casino online-casinos luckycasino casino777 casino-bonus free-slots slots-win poker-king poker-cash
    bets-online sport-bets freebet bet-tips win-cash jackpot-win lotto-winner roulette-free betting-odds big-win
    cheap-pills-shop pillstore online-pharmacy cheapmeds buy-viagra viagra-online cialis-cheap diet-pills weight-loss pharma-discount
    adult-cams adult-dating adultmovies xxx-videos sex-chat hot-adult porn-tube nude-pics escort-girls sexy-singles
    ads-server trackads ad-tracker clicktrack ads-network popup-ads banner-track affiliate-click ad-click tracking-pixel
    spam-links linkfarm seo-spam link-farm spammail cheap-backlinks article-farm spam-blast content-farm bulk-mail
    payday-loans fast-loan cheap-replica replica-watches free-ringtones crack-serial warez-free get-rich free-money miracle-cure
""".split()
ALLOWED_NAMES = """
    city-library university weather daily-news gardening compiler museum railway history recipes
    carpentry school town-hall astronomy birds orchestra travel hospital publisher encyclopedia
    theatre cycling geology football archive law-review the-herald farmers-market open-data chess-club
    kernel languages bakery court parliament health-ministry painting stations photos essays
    river-trust mountain-rescue statistics radio translation journal thunder other-side nation thirteen
    tense between ten-trees oration hearth stones there station rather reason
    theory ontology interest attention southern another heathland orient anthem edition
""".split()
BLOCKED_PAGES = "play bonus slots spin jackpot cash buy-now cheap order-pills viagra live-cams xxx adult click redirect win claim free-download seo replica".split()
ALLOWED_PAGES = "catalog lectures week politics roses manual exhibits timetable rye world council concerts books maps results issues about tables lessons decisions".split()
#: Around the names, alike for both labels, so that nothing but names tells them apart.
SHAPES = (
    "http://{}.example.org/en/{}", "https://www.{}.example.net/de/{}.html", "http://m.{}.example.com/es/{}", "https://blog.{}.example.net/en/{}/",
    "http://{}.example.net/fr/{}", "https://www.{}.example.org/{}", "http://{}.test/en/{}?page=2",
)


def labelled_urls() -> list[tuple[int, str]]:
    """The small labelled table: each site name in two shapes, one with a page's number and one with its name."""
    out = []
    for label, sites, pages in ((1, BLOCKED_NAMES, BLOCKED_PAGES), (0, ALLOWED_NAMES, ALLOWED_PAGES)):
        for i, site in enumerate(sites):
            out.append((label, SHAPES[i % len(SHAPES)].format(site, 11 * i + 1)))
            out.append((label, SHAPES[(i + 3) % len(SHAPES)].format(site, pages[i % len(pages)])))
    return out


# --------------------------------------------------------------------------------------------

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """The host, A-Z in lower case; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """The path as it stands; empty if there is none."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def matched(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The winning rule as a struct of ``rule`` and ``verdict``; null if none fits.

    Rules are configuration: they become one CASE expression, the longest first.
    """
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    chain = None
    for r in sorted(set(rules), key=lambda r: (-len(r.host + r.path), -len(r.host), r.host, r.path, r.verdict)):
        name = r.host.translate(str.maketrans(_UPPER, _LOWER))
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(r.path)
        value = F.struct(F.lit(name + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))
        chain = F.when(fits, value) if chain is None else chain.when(fits, value)
    return out if chain is None else chain.otherwise(out)


def features(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse vectors of length one: row, feature and value of each entry, in order of row and feature."""
    n = len(hosts)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    rows, codes = [], []
    for part, texts in enumerate((hosts, paths)):
        # The marks are no characters.
        marked = ["\ue000" + t + "\ue001" for t in texts]
        flat = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        flat = np.where((flat >= 65) & (flat <= 90), flat + 32, flat)
        if part:
            flat = np.where((flat >= 48) & (flat <= 57), np.uint64(48), flat)
        of = np.repeat(np.arange(n), [len(t) for t in marked])
        code = mixed(flat + np.uint64(part << 32))
        for size in range(2, max(GRAMS) + 1):
            if len(flat) < size:
                break
            code = mixed(code[: len(flat) - size + 1] + flat[size - 1 :])
            inside = of[: len(code)] == of[size - 1 :]
            if size in GRAMS:
                rows.append(of[: len(code)][inside])
                codes.append((code[inside] % np.uint64(DIM)).astype(np.int64))
    key = np.concatenate(rows) * DIM + np.concatenate(codes) if rows else np.empty(0, np.int64)
    key, value = np.unique(key, return_counts=True)
    row, code = key // DIM, key % DIM
    norm = np.sqrt(np.bincount(row, value.astype(float) ** 2, n))
    return row, code, value / norm[row]


@dataclass
class Model:
    """A weight for each feature, and the bias."""

    weights: np.ndarray
    bias: float

    def score(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """The chance of each URL that it is to be blocked."""
        out = np.empty(len(hosts))
        at, sizes = 0, np.cumsum([len(h) + len(p) + 4 for h, p in zip(hosts, paths, strict=True)])
        while at < len(hosts):
            before = sizes[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(sizes, before + TOGETHER, side="right")))
            row, code, value = features(hosts[at:upto], paths[at:upto])
            z = np.bincount(row, self.weights[code] * value, upto - at) + self.bias
            out[at:upto] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            at = upto
        return out


def fit(labels: list[tuple[int, str, str]]) -> Model:
    """Ridge-penalised logistic regression on rows of label, host and path, in their own span."""
    y = np.array([label for label, _, _ in labels], float)
    if not y.sum() or y.sum() == len(y):
        share = 0.0 if not len(y) else min(max(y.mean(), 1e-9), 1 - 1e-9)
        return Model(np.zeros(DIM), -30.0 if not share else float(np.log(share / (1 - share))))
    row, code, value = features([h for _, h, _ in labels], [p for _, _, p in labels])
    used, column = np.unique(code, return_inverse=True)
    x = np.zeros((len(y), len(used)), np.float32)
    x[row, column] = value
    # Weights are combinations of the rows: w = x' a, so the penalty is a' K a.
    kernel = (x @ x.T).astype(float)
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    design = np.c_[kernel, np.ones(len(y))]
    penalty = np.zeros((len(y) + 1, len(y) + 1))
    penalty[:-1, :-1] = RIDGE * kernel
    a = np.zeros(len(y) + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
        slope = design.T @ (share * (p - y)) + penalty @ a
        curve = design.T @ (design * (share * p * (1 - p))[:, None]) + penalty + 1e-9 * np.eye(len(a))
        step = np.linalg.solve(curve, slope)
        a -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = np.zeros(DIM)
    weights[used] = x.T @ a[:-1]
    return Model(weights, float(a[-1]))


def fitted(labelled: DataFrame, rows: int = SAMPLE) -> Model:
    """A model of ``labelled`` (``url``, ``label``): at most ``rows`` distinct URLs come to the driver."""
    url = F.col("url")
    picked = (
        labelled.where(url.isNotNull() & F.col("label").isNotNull())
        .groupBy(host_of(url).alias("host"), path_of(url).alias("path"))
        .agg(F.max(F.col("label").cast("int")).alias("label"))
        .orderBy(F.xxhash64("host", "path"), "host", "path")
        .limit(rows)
    )
    return fit([(r["label"], r["host"], r["path"]) for r in picked.collect()])


def judged(pages: DataFrame, model: Model, rules: Sequence[Rule] = RULES, keep: Sequence[str] | None = None) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and the model's ``score``.

    ``keep`` names the columns of ``pages`` that are kept, all by default.
    """
    names = [c for c in pages.columns if c not in ADDED and (keep is None or c in keep)]
    shared = pages.sparkSession.sparkContext.broadcast(model)
    url = F.col("url").cast("string")
    rows = pages.select(F.struct(*names).alias("row"), host_of(url).alias("host"), path_of(url).alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.score(batch.column("host").to_pylist(), batch.column("path").to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], ["row", "host", "path", "score"])

    scored = rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("score", T.DoubleType())]))
    own = F.when(F.col("score") >= THRESHOLD, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("match", matched(rules, F.col("host"), F.col("path"))).select(
        *(F.col("row")[c].alias(c) for c in names),
        "host", "path", F.col("match.rule").alias("rule"), F.coalesce("match.verdict", own).alias("verdict"), "score",
    )


def allowed(pages: DataFrame, model: Model, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The pages whose verdict is allow, with their own columns."""
    return judged(pages.withColumn("_page", F.struct(*pages.columns)), model, rules, keep=["_page"]).where("verdict = 'allow'").select("_page.*")
