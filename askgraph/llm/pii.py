"""Personal data by weak supervision, in Spark's own functions.

Candidates come from patterns. Labelers vote on each: the regular expression's
strict form (for bank accounts the check digits), a gazetteer (known ends of
domains, prefixes of cards and phones, numbering plans, numbers known as
samples, countries, given names) and the words next to it; each may abstain.
For a kind, the first two look at different properties of the span. Votes are the only
evidence, so equal vote patterns count together: expectation maximisation
estimates on their counts over all documents how reliable each labeler is, and
trains on its own soft labels a log-linear span classifier over votes and shape.
The table of patterns is bounded by the number of kinds, votes and shapes, not
by the data. The classifier's weights become an expression that scores spans.

Base kinds are always reported. Further kinds (local phone numbers, national
ids, bank accounts, named persons) are reported where the classifier says so.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askgraph.llm.common import staged
from askgraph.llm.spans import listed, matches

KINDS = ("email", "ip", "card", "phone", "local_phone", "national_id", "iban", "person")
BASE = KINDS[:4]
ACCEPT = 0.5
ROUNDS = 30
#: Only the start of a run of its own letters can start these, or the end of the match before;
#: possessive, so that long runs cost no backtracking. The matches are those of the plain forms.
PATTERNS = {
    "email": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
    ),
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "local_phone": r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z-])",
    "national_id": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "person": r"\b(?:Mr|Mrs|Ms|Dr|Herr|Frau|Monsieur|Madame|Señor|Señora)\.?\x20[A-Z][a-zß-ÿ]++(?:\x20[A-Z][a-zß-ÿ]++)?\b",
}
#: What a span of the kind looks like in its strict form.
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$",
    "ip": r"^([1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}$",
    "card": r"^([0-9]{4}[\x20-]?){3}[0-9]{1,7}$|^3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}$",
    "phone": r"^\+[1-9][0-9]{0,2}[\x20.-]?\(?[0-9]{2,4}\)?([\x20.-]?[0-9]{2,4}){2,4}$",
    "local_phone": r"^(\([0-9]{3}\)\x20[0-9]{3}-|[0-9]{3}-[0-9]{3}-|[0-9]{3}\.[0-9]{3}\.)[0-9]{4}$",
    "national_id": r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$",
    "person": r"^\S+\x20[A-Z]\S+\x20[A-Z]",
}
#: Given names, countries of bank accounts, numbers printed as samples.
NAMES = (
    "Adam Alan Alejandro Alexander Alice Amanda Amy Ana Andrea Andreas Andrew Angela Anja Ann Anna Anne Antoine "
    "Antonio Barbara Ben Benjamin Brian Camille Carlos Carmen Caroline Catherine Charles Charlotte Chloe Christian "
    "Christine Christopher Claire Claudia Daniel David Diego Dominique Edward Elena Elizabeth Emily Emma Eric Eva "
    "Felix Fernando Florian Francisco Frank Gabriel George Hans Heike Helen Henry Hugo Isabel Jack Jacques James Jan "
    "Jane Javier Jean Jennifer Jessica Joe John Jorge Joseph Juan Julia Julie Karen Karl Katrin Kevin Klaus Laura Leon "
    "Linda Lisa Louis Lucas Lucia Luis Luisa Manuel Marco Margaret Maria Marie Mark Markus Marta Martin Mary Matthew "
    "Max Michael Michel Miguel Monika Nathalie Nicolas Nicole Nina Olivia Pablo Patricia Paul Paula Pedro Peter Petra "
    "Philip Pierre Rachel Rafael Richard Robert Rosa Sabine Sandra Sara Sarah Sebastian Simon Sofia Sophie Stefan "
    "Stephanie Stephen Steven Susan Susanne Sven Teresa Thomas Tim Ursula Uwe Victor Werner William Wolfgang Yves"
).split()
COUNTRIES = (
    "AD AE AL AT AZ BA BE BG BH BR CH CR CY CZ DE DK DO EE ES FI FO FR GB GE GI GL GR GT HR HU IE IL IS IT JO KW KZ "
    "LB LI LT LU LV MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SE SI SK SM TN TR UA VG XK"
).split()
SAMPLE_IDS = ("078-05-1120", "219-09-9999", "123-45-6789", "987-65-4321")
#: Known beginnings or ends.
GAZETTEER = {
    "email": r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|at|ch|mx|ar)$",
    "ip": r"^(?!0\.|127\.|2(2[4-9]|[3-5][0-9])\.)",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|6011|65)",
    "phone": r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "local_phone": r"^\(?[2-9](?!9|11)[0-9]{2}\)?[\x20.-]?(?!555[.-]01)[2-9](?!11)[0-9]{2}",
    "national_id": rf"^(?!({'|'.join(SAMPLE_IDS)})$)(?!([0-9])\2\2-)(?!...-..-([0-9])\3\3\3$)",
    "iban": rf"^({'|'.join(COUNTRIES)})",
    "person": rf"\b({'|'.join(NAMES)})\b",
}
#: Words nearby that speak for the kind.
CUES = {
    "email": r"(?i)\b(e-?mail|mail|contact|contacto|kontakt|write to|correo|courriel)\b",
    "ip": r"(?i)\b(ip|address|host|server|adresse|login|from)\b",
    "card": r"(?i)\b(card|visa|mastercard|credit|karte|carte|tarjeta|payment|cvv|exp)\b",
    "phone": r"(?i)\b(tel|phone|call|fax|mobile|telefon|téléphone|teléfono|whatsapp)\b",
    "local_phone": r"(?i)\b(tel|phone|call|fax|mobile|telefon|téléphone|teléfono)\b",
    "national_id": r"(?i)\b(ssn|social security|tax id|national id|passport|steuer|dni)\b",
    "iban": r"(?i)\b(iban|account|bank|konto|compte|cuenta|bic|swift)\b",
    "person": r"(?i)\b(name|sincerely|dear|contact|signed|by|from)\b",
}
LABELERS = ("regex", "gazetteer", "context")
_CANDIDATE = "array<struct<start:bigint,rank:int,stop:bigint,kind:string,regex:int,gazetteer:int,context:int,shape:int>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Sum of a card number's digits, every second from the right doubled, is a multiple of 10."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))),
        F.lit(0),
        lambda sum_, i: sum_
        + F.when(
            i % 2 == 0,
            F.element_at(
                F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))),
                F.substring(digits, -i, F.lit(1)).cast("int") + 1,
            ),
        ).otherwise(F.substring(digits, -i, F.lit(1)).cast("int")),
    )
    return total % 10 == 0


def _check_digits(account: Column) -> Column:
    """The account's digits and letters (A is 10), the first four last, leave 1 when divided by 97."""
    compact = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substring(compact, 5, 64), F.substring(compact, 1, 4))
    code = F.transform(F.filter(F.split(moved, ""), lambda c: c != ""), F.ascii)
    rest = F.aggregate(
        code,
        F.lit(0),
        lambda rest, c: F.when(c < 65, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97),
    )
    return rest == 1


def _strict(kind: str, value: Column) -> Column:
    return _check_digits(value) if kind == "iban" else value.rlike(STRICT[kind])


def _passes(kind: str):
    def ip(s: Column) -> Column:
        return F.forall(
            F.split(s["value"], r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(
                "^([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
            )
        )

    def card(s: Column) -> Column:
        digits = _digits(s["value"])
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))

    def phone(s: Column) -> Column:
        return F.length(_digits(s["value"])).between(9, 15)

    return {"ip": ip, "card": card, "phone": phone}.get(kind)


def _votes(spans: Column, kind: str) -> Column:
    """Spans as _CANDIDATE: each labeler votes 1 (is personal), -1 (is not) or 0 (abstains)."""
    rank = KINDS.index(kind)
    embedded = r"[A-Za-z0-9]$"

    def one(s: Column) -> Column:
        cue = s["before"].rlike(CUES[kind])
        code = s["before"].rlike(r"(?i)(version|v|rev|build|id|#|no\.?)\x20?$")
        return F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
            F.when(_strict(kind, s["value"]), 1).otherwise(-1).alias("regex"),
            F.when(s["value"].rlike(GAZETTEER[kind]), 1).otherwise(-1).alias("gazetteer"),
            F.when(cue, 1).when(code, -1).otherwise(0).alias("context"),
            (
                s["before"].rlike(embedded).cast("int")
                + 2 * s["after"].rlike("^[A-Za-z0-9]").cast("int")
            ).alias("shape"),
        )

    return F.transform(spans, one).cast(_CANDIDATE)


def _candidates(text: Column) -> list[Column]:
    out = []
    for kind in KINDS:
        spans = matches(text, PATTERNS[kind])
        passes = _passes(kind)
        out.append(_votes(F.filter(spans, passes) if passes else spans, kind).alias(kind))
    return out


def estimate(patterns: list[dict]) -> tuple[dict, float]:
    """Reliability of labelers by kind and the prior, from counts of vote patterns.

    Expectation maximisation for a hidden yes or no per span. ``patterns`` have
    kind, a vote per labeler and n. Sets ``belief`` on each pattern. A labeler
    starts as right four times of five, and counts of one keep estimates off 0 and 1.
    """
    right = {(k, w): 0.8 for k in KINDS for w in LABELERS}
    prior = {k: 0.8 if k in BASE else 0.5 for k in KINDS}
    for _ in range(ROUNDS):
        for p in patterns:
            odds = math.log(prior[p["kind"]] / (1 - prior[p["kind"]]))
            for w in LABELERS:
                r = right[p["kind"], w]
                odds += p[w] * math.log(r / (1 - r))
            p["belief"] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for k in KINDS:
            mine = [p for p in patterns if p["kind"] == k]
            total = sum(p["n"] for p in mine)
            yes = sum(p["n"] * p["belief"] for p in mine)
            prior[k] = min(0.99, max(0.01, (yes + (4 if k in BASE else 1)) / (total + (5 if k in BASE else 2))))
            for w in LABELERS:
                votes = sum(p["n"] for p in mine if p[w])
                agree = sum(
                    p["n"] * (p["belief"] if p[w] > 0 else 1 - p["belief"]) for p in mine if p[w]
                )
                # labelers are better than chance by construction, which also fixes the two sides
                right[k, w] = min(0.99, max(0.55, (agree + 4) / (votes + 5)))
    return right, sum(p["n"] * p["belief"] for p in patterns) / max(1, sum(p["n"] for p in patterns))


def _features(p: dict) -> dict[str, float]:
    out = {"one": 1.0, f"kind={p['kind']}": 1.0, f"shape={p['shape']}": 1.0}
    for w in LABELERS:
        out[f"{w}={p[w]}"] = 1.0
        out[f"{p['kind']},{w}={p[w]}"] = 1.0
    return out


def fit_classifier(patterns: list[dict], steps: int = 200, rate: float = 0.3) -> dict[str, float]:
    """Log-linear weights from soft labels on pattern counts, by gradient steps."""
    weights: dict[str, float] = {}
    rows = [(_features(p), p["n"], p["belief"]) for p in patterns]
    total = max(1, sum(n for _, n, _ in rows))
    speed: dict[str, float] = {}
    for _ in range(steps):
        slope: dict[str, float] = {}
        for features, n, belief in rows:
            score = sum(weights.get(f, 0.0) * x for f, x in features.items())
            gap = (belief - 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))) * n / total
            for f, x in features.items():
                slope[f] = slope.get(f, 0.0) + gap * x
        for f, g in slope.items():
            g -= 1e-4 * weights.get(f, 0.0)
            speed[f] = speed.get(f, 0.0) + g * g
            weights[f] = weights.get(f, 0.0) + rate * g / (math.sqrt(speed[f]) + 1e-9)
    return weights


def _score(weights: dict[str, float], s: Column) -> Column:
    """The classifier as an expression over a candidate."""
    known = F.create_map(*(x for f, w in sorted(weights.items()) for x in (F.lit(f), F.lit(w))))

    def weight(name: Column) -> Column:
        return F.coalesce(known[name], F.lit(0.0))

    score = weight(F.lit("one")) + weight(F.concat(F.lit("kind="), s["kind"]))
    score = score + weight(F.concat(F.lit("shape="), s["shape"].cast("string")))
    for w in LABELERS:
        vote = F.concat(F.lit(f"{w}="), s[w].cast("string"))
        score = score + weight(vote) + weight(F.concat(s["kind"], F.lit(","), vote))
    return 1 / (1 + F.exp(-score))


def find_personal_data(
    docs: DataFrame,
    accept: float = ACCEPT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Personal data of each document: counts and places of base kinds, and all spans.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base
    spans as kind:start:end by start, then kind, comma-joined; positions in code
    points, end exclusive) and spans (base ones and those of other kinds that
    the classifier gives at least ``accept`` and that overlap no base span, joined
    likewise).

    A null text counts as empty. Null and repeated doc_ids are rows like others;
    repeated texts count as often as they occur in the estimates. Without any
    candidate there are no spans. An empty table gives no rows. Other columns
    are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = staged(docs.sparkSession, rows.select("doc_id", *_candidates(text)), "candidates")
    features = ["kind", *LABELERS, "shape"]
    counted = (
        found.select(F.explode(F.concat(*KINDS)).alias("c"))
        .groupBy(*(F.col(f"c.{f}").alias(f) for f in features))
        .agg(F.count("*").alias("n"))
    )
    patterns = sorted((row.asDict() for row in counted.collect()), key=lambda p: [p[f] for f in features])
    more = F.array().cast(_CANDIDATE)
    if patterns:
        estimate(patterns)
        weights = fit_classifier(patterns)
        base = F.concat(*BASE)
        more = F.filter(
            F.concat(*KINDS[4:]),
            lambda s: (_score(weights, s) >= accept)
            & ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])),
        )

    def plain(spans: Column) -> Column:
        return F.transform(
            spans, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "rank", "stop", "kind")))
        )

    base = F.concat(*BASE)
    return found.select(
        "doc_id",
        *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE),
        F.sha2(listed(plain(base)), 256).alias("base_sha256"),
        listed(plain(F.concat(base, more))).alias("spans"),
    )


