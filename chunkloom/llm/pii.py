"""Personal data by weak supervision. DataFrame functions only.

Patterns propose spans. Labelers (pattern, check sum, gazetteer, context and neighbourhood) each vote for,
against or not at all. Expectation-maximisation over the counts of vote patterns estimates how reliable every
labeler is and how likely each pattern of votes is personal data; a logistic span classifier is then fitted to
those likelihoods on features of the span alone, again over counts. Only tables of counts, whose size the number
of labelers and feature values bounds, come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, row_key, written
from .spans import pattern_spans, per_row

# ---- fixed values: the base patterns of the contract, in the order in which kinds are listed.
# Possessive quantifiers and the look-behind only save time and stack: from the first character of a run a match
# fails if it fails from any later one.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# ---- further kinds that may hold personal data.
MORE = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "number": r"(?<![0-9A-Za-z.,+-])[0-9]{9,15}(?![0-9A-Za-z-])",
    "masked": r"[A-Za-z0-9._%+-]{2,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{2,63}(?:\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z0-9-]{2,63})+",
}
KINDS = [*BASE, *MORE]
# Cheaper patterns that a text must hold for a pattern to be worth trying.
TESTS = {"email": "@", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]", "masked": r"[\[(](?:at|AT)[\])]"}
ENDINGS = "com org net edu gov int info biz io co eu de fr es uk us ch at it nl be pl".split()
CALLING_CODES = "1 7 20 27 30 31 32 33 34 39 41 43 44 45 46 47 48 49 52 55 61 81 82 86 90 91".split()
CUES = "mail email e-mail contact phone tel call fax mobile address server login card visa account iban ssn konto karte adresse telefon courriel carte correo tarjeta".split()
AGAINST = "version build isbn issn doi order ticket invoice serial part chapter section figure table".split()
NEAR = 48
LABELERS = ["pattern", "check", "gazetteer", "cue", "warning", "neighbour"]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = digits.substr(i, F.lit(1)).cast("int")
        twice = F.when((n - i) % 2 == 1, d * 2).otherwise(d)
        return acc + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def passes(kind: Column, value: Column) -> Column:
    """Whether a match of a base kind meets the kind's further conditions."""
    octet = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    digits = _digits(value)
    n = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", value.rlike(rf"^{octet}\.{octet}\.{octet}\.{octet}$"))
        .when(kind == "card", F.when(n.between(16, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(8, 15))
        .otherwise(F.lit(False))
    )


def candidates(docs: DataFrame) -> DataFrame:
    """One row per proposed span: keys, kind, start, end, value, before, base (meets the contract)."""
    rows = pattern_spans(docs, {**BASE, **MORE}, TESTS, NEAR)
    # Runs of digits are everywhere; only those long enough to be a card are proposed.
    rows = rows.where((F.col("kind") != "card") | (F.length(_digits(F.col("value"))) >= 12))
    return rows.withColumn("base", passes(F.col("kind"), F.col("value")))


def _word(words: list[str]) -> str:
    return rf"(?:^|[^a-z])(?:{'|'.join(words)})[^a-z]*(?:[a-z]+[^a-z]+){{0,3}}$"


def votes(spans: DataFrame) -> DataFrame:
    """Adds one column per labeler: 1 personal, -1 not, 0 no opinion; and the features of the span."""
    kind, value = F.col("kind"), F.col("value")
    digits = _digits(value)
    strict = F.col("base") | (kind == "iban") | (kind == "ssn") | (kind == "masked")
    check = (
        F.when(kind == "card", F.when(luhn(digits) & F.length(digits).between(13, 19), 1).otherwise(-1))
        .when(kind == "ip", F.when(F.col("base"), 1).otherwise(-1))
        .when(kind == "phone", F.when(F.col("base"), 1).otherwise(-1))
        .when(kind == "number", F.when(luhn(digits), 1).otherwise(-1))
        .otherwise(0)
    )
    ending = F.lower(F.regexp_extract(value, r"([A-Za-z]+)\W*$", 1))
    code = F.regexp_extract(value, r"^\+(" + "|".join(sorted(CALLING_CODES, key=len)) + ")", 1)
    listed = (
        F.when(kind.isin("email", "masked"), F.when(ending.isin(ENDINGS), 1).otherwise(-1))
        .when(kind == "phone", F.when(code != "", 1).otherwise(-1))
        .when(kind == "ip", F.when(value.rlike(r"^(?:0|10|127|255|192\.168)\."), -1).otherwise(1))
        .otherwise(0)
    )
    near = spans.groupBy(*KEY).agg(F.count("*").alias("in_doc"), F.count_if("base").alias("base_in_doc"))
    out = spans.join(near, KEY)
    others = F.col("base_in_doc") - F.col("base").cast("int")
    return out.select(
        *spans.columns,
        F.when(strict, 1).otherwise(-1).alias("pattern"),
        check.alias("check"),
        listed.alias("gazetteer"),
        F.when(F.col("before").rlike(_word(CUES)), 1).otherwise(0).alias("cue"),
        F.when(F.col("before").rlike(_word(AGAINST)), -1).otherwise(0).alias("warning"),
        F.when(others > 0, 1).otherwise(0).alias("neighbour"),
        F.least(F.floor(F.length("value") / 6), F.lit(6)).cast("int").alias("f_length"),
        F.least(F.floor(F.length(digits) * 4 / F.length("value")), F.lit(4)).cast("int").alias("f_digits"),
        value.rlike("[A-Za-z]").cast("int").alias("f_letters"),
        F.col("base").cast("int").alias("f_base"),
    )


def reliabilities(counts: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[dict, float, dict]:
    """Expectation-maximisation: chance of each vote given the class, share of the class, belief per pattern."""
    values = (-1, 0, 1)
    # A start in which labelers are somewhat better than chance fixes which class is which.
    chance = {(j, c, v): (0.5 if v == (1 if c else -1) else 0.3 if v == 0 else 0.2) for j in range(len(LABELERS)) for c in (0, 1) for v in values}
    share, belief = 0.5, {}
    total = sum(n for _, n in counts) or 1
    for _ in range(rounds):
        for pattern, _ in counts:
            logs = [math.log(1 - share), math.log(share)]
            for j, v in enumerate(pattern):
                for c in (0, 1):
                    logs[c] += math.log(chance[j, c, v])
            belief[pattern] = 1 / (1 + math.exp(max(-700.0, min(700.0, logs[0] - logs[1]))))
        mass = sum(n * belief[p] for p, n in counts)
        share = min(0.999, max(0.001, (mass + 1) / (total + 2)))
        for j in range(len(LABELERS)):
            for c, whole in ((1, mass), (0, total - mass)):
                for v in values:
                    got = sum(n * (belief[p] if c else 1 - belief[p]) for p, n in counts if p[j] == v)
                    chance[j, c, v] = (got + 1) / (whole + 3)
    return chance, share, belief


FEATURES = ["kind", "f_length", "f_digits", "f_letters", "f_base"]


def logistic(cells: list[tuple[tuple, float, float]], rounds: int = 200, rate: float = 1.0) -> dict:
    """Weights of one-hot features fitted to (features, positive mass, mass) cells, lightly penalised."""
    weights: dict = {}
    total = sum(m for *_, m in cells) or 1.0
    for _ in range(rounds):
        slope: dict = {}
        bend: dict = {}
        for key, positive, mass in cells:
            names = ["bias", *zip(FEATURES, key)]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(weights.get(n, 0.0) for n in names)))))
            for n in names:
                slope[n] = slope.get(n, 0.0) + positive - mass * p
                bend[n] = bend.get(n, 0.0) + mass * p * (1 - p)
        moved = 0.0
        for n in slope:
            step = rate * (slope[n] - 1e-3 * weights.get(n, 0.0)) / (len(FEATURES) + 1) / (bend[n] + 1e-3 * total / 100 + 1.0)
            weights[n] = weights.get(n, 0.0) + step
            moved = max(moved, abs(step))
        if moved < 1e-6:
            break
    return weights


def _lookup(column: str, weights: dict) -> Column:
    out = F.lit(0.0)
    for n, w in sorted((n, w) for n, w in weights.items() if n != "bias" and n[0] == column):
        out = F.when(F.col(column) == F.lit(n[1]), F.lit(float(w))).otherwise(out)
    return out


def personal_spans(docs: DataFrame) -> DataFrame:
    """k1, k2, kind, start, end, base, probability, personal of every proposed span.

    ``personal`` holds for spans of the base kinds and for those the classifier accepts. ``docs`` has k1, k2, text.
    """
    proposed = written(candidates(docs), "pii-candidates")
    voted = written(votes(proposed), "pii-votes")
    counts = voted.groupBy(*LABELERS).count().collect()  # at most 3 ** 6 rows
    told = sorted((tuple(r[c] for c in LABELERS), r["count"]) for r in counts)
    _, _, belief = reliabilities(told)
    cells = voted.groupBy(*LABELERS, *FEATURES).count().collect()  # bounded by the values of both
    summed: dict = {}
    for r in cells:
        key = tuple(r[c] for c in FEATURES)
        b = belief[tuple(r[c] for c in LABELERS)]
        p, m = summed.get(key, (0.0, 0.0))
        summed[key] = (p + b * r["count"], m + r["count"])
    weights = logistic([(k, p, m) for k, (p, m) in sorted(summed.items())])
    z = F.lit(float(weights.get("bias", 0.0)))
    for column in FEATURES:
        z = z + _lookup(column, weights)
    probability = 1 / (1 + F.exp(-z))
    out = voted.select(*KEY, "kind", "start", "end", "base", probability.alias("probability"))
    return out.withColumn("personal", F.col("base") | (F.col("probability") >= 0.5))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``spans`` (kind, start, end, base) of every row, which replaces one of that name.

    Spans of the base kinds are all kept; an added span that overlaps a base span, or an added one that starts
    earlier, is left out. Null and empty texts have no spans; repeated rows have their spans each; an empty table
    gives no rows.
    """
    own = [F.col(f"`{c}`").alias(f"o_{c}") for c in docs.columns if c != "spans"]
    rows = docs.select(*own, *row_key("`doc_id`", "`text`"))
    spans = personal_spans(rows.select(*KEY, F.col("o_text").alias("text"))).where("personal")
    out = per_row(rows, spans)
    return out.select(*[F.col(f"`o_{c}`").alias(c) for c in docs.columns if c != "spans"], "spans")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one mark."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        mark = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], mark)).otherwise(acc["out"]).alias("out"),
        )

    return F.when(F.size(spans) > 0, F.aggregate(ordered, start, step, lambda a: F.concat(
        a["out"], F.substring(text, a["at"] + 1, F.length(text))))).otherwise(text)
