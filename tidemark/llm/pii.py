"""Personal data in texts: base patterns that always count, and spans that boosted trees add.

Everything runs as DataFrame and SQL expressions. Wide generators propose
overlapping spans; their format and the text before them become a few small
numbers; the corpus is reduced to one count per combination of those numbers,
on which the trees are grown; the trees go back into the scan as one CASE
expression per kind.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, pick

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 30
RATE = 0.3
PRECISION = 0.98
LEAST_SUPPORT = 20

# The base patterns. Possessive forms and anchors change no match: they keep
# long runs from being tried again from every character.
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be tried at all.
GUARD = {"email": "contains({t}, '@')", "ip": "{t} RLIKE '[0-9][.][0-9]'", "card": "{t} RLIKE '[0-9][ -]?[0-9]'", "phone": "contains({t}, '+')"}

# High-recall generators: what else could be of a kind.
_TOKEN = r"\s@<>(),;:"
WIDE = (
    ("email", rf"(?:\G|(?<![^{_TOKEN}]))[^{_TOKEN}]++@[^{_TOKEN}]++", "contains({t}, '@')"),
    ("ip", r"(?<![0-9])[0-9]{1,4}+(?:\x20?[.]\x20?[0-9]{1,4}+){3}+(?![0-9])", "{t} RLIKE '[0-9] ?[.]'"),
    ("card", r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){11,18}+(?![0-9])", "{t} RLIKE '[0-9][ .-]?[0-9]'"),
    ("phone", r"(?<![0-9])(?:[+]|00)?[(]?[0-9](?:[\x20().-]{0,3}[0-9]){6,14}+(?![0-9])", "{t} RLIKE '[0-9][ ().-]{{0,3}}[0-9]'"),
    ("phone", r"(?:(?<![0-9(])|(?=[(]))[(]?[0-9]{3}[)]?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", "{t} RLIKE '[0-9]{{3}}[ .-][0-9]{{4}}'"),
)
HINTS = "(?i)(tel|phone|call|fax|mobile|mail|contact|card|visa|pay|host|server|addr|ip)[^a-z]{0,6}$"

_SPAN = "array<struct<s:int,e:int,m:string,b:string>>"
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


def _found(text: str, pattern: str, guard: str) -> str:
    """SQL: spans (start, end, match, 16 characters before) in code points, added up from the gaps between matches."""
    return f"""CASE WHEN {guard.format(t=text)} THEN aggregate(
        zip_with(split({text}, r'{pattern}', -1), regexp_extract_all({text}, r'{pattern}', 0), (g, m) -> struct(g AS g, m AS m)),
        struct(0 AS at, CAST(array() AS {_SPAN}) AS out),
        (acc, x) -> struct(
            acc.at + char_length(x.g) + coalesce(char_length(x.m), 0) AS at,
            CASE WHEN x.m IS NULL THEN acc.out ELSE concat(acc.out, array(struct(
                acc.at + char_length(x.g) AS s, acc.at + char_length(x.g) + char_length(x.m) AS e, x.m AS m, right(x.g, 16) AS b
            ))) END AS out),
        acc -> acc.out) ELSE CAST(array() AS {_SPAN}) END"""


def _luhn(digits: str) -> str:
    return f"""CASE WHEN length({digits}) BETWEEN 12 AND 19 THEN aggregate(sequence(1, length({digits})), 0, (sum, i) -> sum +
        CASE WHEN (length({digits}) - i) % 2 = 0 THEN int(substr({digits}, i, 1))
        ELSE int(substr(translate({digits}, '0123456789', '0246813579'), i, 1)) END) % 10 = 0 ELSE false END"""


_DIGITS = "transform({spans}, x -> struct(x.s AS s, x.e AS e, x.m AS m, x.b AS b, regexp_replace(x.m, '[^0-9]', '') AS d))"
_CHECKS = {
    "email": "true",
    "ip": f"x.m RLIKE '^{_OCTET}([.]{_OCTET}){{3}}$'",
    "card": _luhn("x.d"),
    "phone": "length(x.d) BETWEEN 9 AND 15",
}


def _base(kind: str) -> str:
    spans = _DIGITS.format(spans=_found("text", BASE[kind], GUARD[kind]))
    return f"transform(filter({spans}, x -> {_CHECKS[kind]}), x -> struct(x.s AS s, {KINDS.index(kind)} AS k, x.e AS e))"


# Each feature is a small whole number; no combination of them is unbounded.
FEATURES = {
    "digits": "CASE WHEN length(x.d) < 7 THEN 0 WHEN length(x.d) < 10 THEN 1 WHEN length(x.d) < 12 THEN 2 WHEN length(x.d) < 16 THEN 3 ELSE 4 END",
    "lead": "int(x.m RLIKE '^([+]|00)')",
    "brackets": "int(x.m RLIKE '[(][0-9]+[)]')",
    "gaps": "CASE WHEN x.m RLIKE '[0-9] [0-9]' THEN 1 WHEN x.m RLIKE '[0-9]-[0-9]' THEN 2 WHEN x.m RLIKE '[0-9][.][0-9]' THEN 3 ELSE 0 END",
    "tail": "int(x.m RLIKE '[0-9]{3}[ .-][0-9]{4}$')",
    "luhn": f"int({_luhn('x.d')})",
    "octets": f"int(x.m RLIKE '^{_OCTET}([.]{_OCTET}){{3}}$')",
    "domain": "int(x.m RLIKE '[.][A-Za-z]{2,}$')",
    "before": "CASE WHEN x.b RLIKE '[A-Za-z]$' THEN 1 WHEN x.b RLIKE '[^A-Za-z\\\\s(]$' THEN 2 ELSE 0 END",
    "hint": f"int(x.b RLIKE '{HINTS}')",
}


def _candidates(generator: tuple[str, str, str]) -> str:
    kind, pattern, guard = generator
    spans = _DIGITS.format(spans=_found("text", pattern, guard))
    fields = ", ".join(f"{sql} AS {name}" for name, sql in FEATURES.items())
    return f"transform({spans}, x -> struct(x.s AS s, {KINDS.index(kind)} AS k, x.e AS e, {fields}))"


def _over(a: str, b: str) -> str:
    return f"({a}.s < {b}.e AND {b}.s < {a}.e)"


@dataclass
class Tree:
    """One test, a second one on either side, and the values of the four ends."""

    root: tuple[str, int]
    sides: tuple[tuple[str, int], tuple[str, int]]
    values: tuple[float, float, float, float]

    def value(self, row: dict) -> float:
        side = int(row[self.root[0]] > self.root[1])
        name, cut = self.sides[side]
        return self.values[2 * side + int(row[name] > cut)]

    def sql(self, at: str) -> str:
        (f, c), ((f0, c0), (f1, c1)), (a, b, d, e) = self.root, self.sides, self.values
        return (
            f"CASE WHEN {at}.{f} <= {c} THEN CASE WHEN {at}.{f0} <= {c0} THEN {a!r}D ELSE {b!r}D END"
            f" ELSE CASE WHEN {at}.{f1} <= {c1} THEN {d!r}D ELSE {e!r}D END END"
        )


@dataclass
class KindModel:
    """Boosted trees of a kind and the least score that its held-out precision supports."""

    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    threshold: float = math.inf

    def score(self, row: dict) -> float:
        return sum((t.value(row) for t in self.trees), self.start)

    def sql(self, at: str) -> str:
        """Whether the candidate ``at`` is taken."""
        if math.isinf(self.threshold):
            return "false"
        return " + ".join([f"{self.start!r}D", *(f"({t.sql(at)})" for t in self.trees)]) + f" >= {self.threshold!r}D"


def _split(rows: list[dict], names: list[str]) -> tuple[float, tuple[str, int], float, float]:
    """Best test of the rows by second-order gain, with the values of both sides."""
    total_g, total_h = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    best = (-math.inf, (names[0], 1 << 20), 0.0, 0.0)
    for name in names:
        for cut in sorted({r[name] for r in rows}):
            g = sum(r["g"] for r in rows if r[name] <= cut)
            h = sum(r["h"] for r in rows if r[name] <= cut)
            gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1)
            if gain > best[0] + 1e-12:
                best = (gain, (name, cut), -RATE * g / (h + 1), -RATE * (total_g - g) / (total_h - h + 1))
    return best


def boost(rows: list[dict]) -> KindModel:
    """Trees on rows of feature values with ``n`` candidates, ``y`` of them positive, ``held_out`` or not.

    The threshold is the lowest held-out score from which on the share of
    positives is at least ``PRECISION``, with ``LEAST_SUPPORT`` candidates
    behind it; without such a score the kind adds nothing.
    """
    names = list(FEATURES)
    train = [dict(r) for r in rows if not r["held_out"]]
    n, y = sum(r["n"] for r in train), sum(r["y"] for r in train)
    if not n:
        return KindModel()
    model = KindModel(math.log((y + 0.5) / (n - y + 0.5)))
    for _ in range(ROUNDS):
        for r in train:
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, model.score(r)))))
            r["g"], r["h"] = r["n"] * p - r["y"], r["n"] * p * (1 - p)
        _, root, *_ = _split(train, names)
        sides = [_split([r for r in train if (r[root[0]] > root[1]) == side], names) for side in (False, True)]
        model.trees.append(Tree(root, (sides[0][1], sides[1][1]), (*sides[0][2:], *sides[1][2:])))
    scored = sorted(((model.score(r), r["n"], r["y"]) for r in rows if r["held_out"]), reverse=True)
    seen = good = 0
    for i, (score, count, positive) in enumerate(scored):
        seen, good = seen + count, good + positive
        last = i + 1 == len(scored) or scored[i + 1][0] < score
        if last and seen >= LEAST_SUPPORT and good >= PRECISION * seen:
            model.threshold = score - 1e-9
        elif last and good < PRECISION * seen and seen >= LEAST_SUPPORT:
            break
    return model


def with_base(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, base): all base spans (start, kind, end) in order."""
    rows = pick(docs, doc_id=doc_id, text=text).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return rows.withColumn("base", F.expr(f"array_sort(concat({', '.join(_base(k) for k in KINDS)}))"))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> dict[str, KindModel]:
    """One model per kind from all texts.

    A candidate counts as positive where it overlaps a base span of its kind.
    Only counts per combination of feature values and fold leave the cluster;
    their number is bounded by the features, not by the data.
    """
    rows = with_base(docs, doc_id, text).withColumn("held_out", F.coalesce(fold("doc_id") == 0, F.lit(False)))
    marked = rows.select("held_out", "base", F.explode(F.expr(f"concat({', '.join(map(_candidates, WIDE))})")).alias("c"))
    hit = F.expr(f"exists(base, b -> b.k = c.k AND {_over('b', 'c')})").cast("int").alias("hit")
    counts = marked.select("held_out", hit, "c.k", *[f"c.{f}" for f in FEATURES]).groupBy("held_out", "k", *FEATURES).agg(
        F.count("*").alias("n"), F.sum("hit").alias("y")
    )
    found = [r.asDict() for r in counts.collect()]
    return {kind: boost([r for r in found if r["k"] == i]) for i, kind in enumerate(KINDS)}


def find(docs: DataFrame, models: dict[str, KindModel], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, text, base, spans), both arrays of (start, kind, end).

    ``spans`` holds all base spans, and the candidates that their model takes
    and that overlap none of them; of two such candidates that overlap, the
    kind listed first stays. Positions are code points, ends are exclusive.
    NULL texts count as empty.
    """
    rows = with_base(docs, doc_id, text)
    extra = "CAST(array() AS array<struct<s:int,k:int,e:int>>)"
    for generator in WIDE:
        rule = models[generator[0]].sql("c")
        if rule != "false":
            taken = f"filter({_candidates(generator)}, c -> {rule})"
            taken = f"transform({taken}, c -> struct(c.s AS s, c.k AS k, c.e AS e))"
            rows = rows.withColumn("taken", F.expr(taken)).withColumn("extra", F.expr(extra))
            rows = rows.withColumn(
                "extra",
                F.expr(f"concat(extra, filter(taken, c -> NOT exists(base, b -> {_over('b', 'c')}) AND NOT exists(extra, b -> {_over('b', 'c')})))"),
            ).drop("taken")
            extra = "extra"
    return rows.withColumn("spans", F.expr(f"array_sort(concat(base, {extra}))")).select("doc_id", "text", "base", "spans")


_NAMES = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"


def _joined(spans: str) -> str:
    return f"array_join(transform({spans}, x -> concat_ws(':', element_at({_NAMES}, x.k + 1), string(x.s), string(x.e))), ',')"


def digests(found: DataFrame) -> DataFrame:
    """Counts per kind of base spans, the hash of their list, and the list of all spans."""
    return found.select(
        "doc_id",
        *[F.expr(f"bigint(size(filter(base, x -> x.k = {i})))").alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.expr(f"sha2({_joined('base')}, 256)").alias("base_sha256"),
        F.expr(_joined("spans")).alias("spans"),
    )


def redact(found: DataFrame) -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    text = f"""aggregate(spans, struct('' AS done, 0 AS at), (acc, x) -> struct(
        CASE WHEN x.s < acc.at THEN acc.done
        ELSE concat(acc.done, substr(text, acc.at + 1, x.s - acc.at), '[', upper(element_at({_NAMES}, x.k + 1)), ']') END AS done,
        greatest(acc.at, x.e) AS at), acc -> concat(acc.done, substr(text, acc.at + 1)))"""
    return found.select("doc_id", F.expr(text).alias("text"))
